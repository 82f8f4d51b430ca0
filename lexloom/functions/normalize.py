"""Normal forms of terms, bodies and pages as Column functions; each form is a function of its own.

Unicode: accents are folded by one explicit table (FOLD_FROM, FOLD_TO), which the SQL twins share. Null stays null.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters whose marks are dropped, with what is left (fixed values).
FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
FOLD_TO = "aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY"
PAGE_OFFSET, LAST_PAGE = 11, 1238


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fold(x):
    """Accents dropped, what is then not ASCII deleted."""
    return F.regexp_replace(F.translate(col(x), FOLD_FROM, FOLD_TO), r"[^\x00-\x7F]", "")


def chars(x):
    """Straight quotes, plain hyphens, no ligatures, no byte order mark (N1, the listed characters)."""
    x = F.translate(col(x), "‘’“”– ", "''\"\"- ")
    return F.replace(F.replace(F.replace(x, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl")), F.lit("﻿"), F.lit(""))


@F.pandas_udf(StringType())
def chars_exact(x: pd.Series) -> pd.Series:
    """N1 with full compatibility composition."""
    table = str.maketrans({"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", " ": " ", "ﬁ": "fi", "ﬂ": "fl", "﻿": None})
    return x.map(lambda t: unicodedata.normalize("NFKC", t).translate(table), na_action="ignore")


@F.pandas_udf(StringType())
def unmarked_exact(x: pd.Series) -> pd.Series:
    """All combining marks dropped after compatibility decomposition (for N4, N5, N10, N11)."""
    return x.map(lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)), na_action="ignore")


def strip(x):
    return F.regexp_replace(col(x), r"^\s+|\s+$", "")


def space(x):
    """Runs of white space to one blank, ends stripped."""
    return strip(F.regexp_replace(col(x), r"\s+", " "))


def line_text(x):
    """A scanned line: N1, then no space before closing or after opening marks, nor after a leading dash."""
    x = F.regexp_replace(F.regexp_replace(chars(x), r"\s+([,.;:?!\)])", "$1"), r"([\(\[])\s+", "$1")
    return space(F.regexp_replace(x, "^—\\s+", "—"))


def term(x):
    """Upper case without marks, dash to hyphen, blanks collapsed, then trailing .,;: dropped."""
    x = F.replace(F.upper(F.translate(chars(x), FOLD_FROM, FOLD_TO)), F.lit("—"), F.lit("-"))
    return F.regexp_replace(space(x), "[.,;:]+$", "")


def norm(x):
    """Upper case without marks; trailing .,;: dropped before blanks are collapsed."""
    return space(F.regexp_replace(F.upper(F.translate(col(x), FOLD_FROM, FOLD_TO)), r"[.,;:]+\z", ""))


def headword(x):
    """Upper, ligatures spelled out, trailing marks and dashes dropped, blanks collapsed."""
    x = F.replace(F.replace(F.upper(col(x)), F.lit("Æ"), F.lit("AE")), F.lit("Œ"), F.lit("OE"))
    return space(F.regexp_replace(strip(x), "[.,;:—-]+$", ""))


def header_term(x):
    """N6 with brackets and quotes dropped at both ends."""
    return strip(F.regexp_replace(headword(x), r"^[\[\](){}\"'.,;:\s-]+|[\[\](){}\"'.,;:\s-]+$", ""))


def letters_only(x):
    """Upper case, anything but A-Z and blanks deleted."""
    return strip(F.regexp_replace(F.upper(col(x)), "[^A-Z ]", ""))


def alnum_only(x):
    """Upper case, anything but A-Z, 0-9 and blanks deleted."""
    return strip(F.regexp_replace(F.upper(col(x)), "[^A-Z0-9 ]", ""))


def search_key(x):
    """Lower case, other characters to single blanks, ends stripped."""
    return strip(F.regexp_replace(F.lower(F.translate(col(x), FOLD_FROM, FOLD_TO)), "[^a-z0-9]+", " "))


def slug(x):
    """N10 with dashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.translate(col(x), FOLD_FROM, FOLD_TO)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def body_key(x, limit: int | None = None):
    """Blanks collapsed, upper case, cut to limit."""
    x = F.upper(space(x))
    return F.substring(x, 1, limit) if limit else x


def ocr_key(x):
    """Look-alikes to letters: ! 1 | to I, 0 to O, Z to E."""
    return F.translate(F.upper(col(x)), "!1|0Z", "IIIOE")


def match_key(x):
    """N9 without blanks."""
    return F.regexp_replace(F.upper(col(x)), "[^A-Z0-9]", "")


def filing_letter(x):
    """First A-Z of N4, else #."""
    got = F.regexp_extract(term(x), "[A-Z]", 0)
    return F.when(got == "", "#").otherwise(got)


def alpha_letter(x):
    """First letter in upper case, else ? (N15, second form)."""
    got = F.upper(F.regexp_extract(col(x), r"\p{L}", 0))
    return F.when(got == "", "?").otherwise(got)


def shard_letter(x):
    """First character in upper case; A for the empty term (N15, third form)."""
    return F.when(col(x) == "", "A").otherwise(F.upper(F.substring(col(x), 1, 1)))


def clean_headword(x):
    """Blanks collapsed, trailing .,;: dropped."""
    return F.regexp_replace(space(x), "[.,;:]+$", "")


def page_list(x):
    """Numbers of a comma-separated page string, others dropped."""
    return F.filter(F.transform(F.split(col(x), ","), lambda p: F.trim(p).try_cast("int")), lambda p: p.isNotNull())


def leaf_to_page(leaves):
    """Printed pages of leaves; front matter dropped."""
    return F.filter(F.transform(col(leaves), lambda x: x - PAGE_OFFSET), lambda p: p > 0)


def page_to_leaf(page):
    return col(page) + PAGE_OFFSET


def preview(x, n: int = 80):
    """First n characters, line feeds as blanks."""
    return F.replace(F.substring(col(x), 1, n), F.lit("\n"), F.lit(" "))


def stable_id(index):
    """BLD2-00042."""
    return F.format_string("BLD2-%05d", col(index))


def severity(n):
    """clean, low to 5, medium to 50, high."""
    n = col(n)
    return F.when(n == 0, "clean").when(n <= 5, "low").when(n <= 50, "medium").otherwise("high")


def escape_html(x):
    """Markup characters as references."""
    x = col(x)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def quoted(x):
    """A term as a literal pattern whose blanks match any white space."""
    return F.concat(F.lit("\\Q"), F.replace(col(x), F.lit(" "), F.lit("\\E\\s+\\Q")), F.lit("\\E"))


def in_letters(letter, given: str):
    """Whether a letter is in a range such as A or D-M."""
    a, _, b = given.upper().partition("-")
    return col(letter).between(a.strip(), (b or a).strip())


def union_box(df, *keys):
    """Smallest box around the boxes x0, y0, x1, y1 of each key; zeros for none."""
    return df.groupBy(*keys).agg(*(F.coalesce(f(c), F.lit(0)).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))))
