"""Queries of search, normal forms, cleaning and likeness."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import normalize as N
from ..functions import similarity as S
from ..operators import audit as V
from ..operators import joins as J
from ..operators import search as Q
from ..operators.scan import shared_folder
from .lexicon import FOLD_FROM, FOLD_TO, SQL, lexicon, table
from .registry import query

LEX = f"with {SQL}"
KEY = "regexp_replace(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
SCORED = f"""with {SQL}, scored as (select *, {KEY.format("term")} as tk, {KEY.format("body")} as bk, 'the' as q from lex),
ranked as (select index, term, cast(case when tk = q then 100 when starts_with(tk, q) then 80 when contains(tk, q) then 60 when contains(bk, q) then 20 else -1 end as int) as score from scored)
"""


@query(SCORED + "select index, term, score from ranked where score >= 0 order by score desc, term, index limit 80")
def search_ranked(spark, sf):
    return Q.ranked(lexicon(spark, sf), "The").select("index", "term", "score")


@query(SCORED.replace("'the' as q", "'in the' as q") + "select index, term, score from ranked where score >= 0")
def search_indexed(spark, sf):
    """All hits of a phrase through the posting lists of a search index that is written first."""
    folder = f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
    Q.build_index(lexicon(spark, sf), folder)
    return Q.search(spark, folder, "In the", None)


@query(SCORED + "select score, count(*) as hits from ranked where score >= 0 group by score")
def search_count(spark, sf):
    return Q.hits(lexicon(spark, sf), "The").groupBy("score").agg(F.count("*").alias("hits"))


@query(LEX + "select index, term from lex where upper(substr(term, 1, 1)) = 'T'")
def browse_letter(spark, sf):
    return Q.browse(lexicon(spark, sf), "t").select("index", "term")


@query(LEX + "select index, term from lex where trim(regexp_replace(lower(term), '[^a-z0-9]+', '-', 'g'), '-') = 'the-and'")
def slug_lookup(spark, sf):
    return Q.by_slug(lexicon(spark, sf), "the-and").select("index", "term")


@query(LEX + "select index, term, length(body) as n from lex order by n desc, index limit 1")
def first_hit(spark, sf):
    return Q.top_by(lexicon(spark, sf).withColumn("n", F.length("body").cast("long")), F.col("n"), 1, "index").select("index", "term", "n")


@query(LEX + "select index, term, length(body) as n from lex order by n desc, index limit 50")
def longest_bodies(spark, sf):
    return Q.top_by(lexicon(spark, sf).withColumn("n", F.length("body").cast("long")), F.col("n"), 50, "index").select("index", "term", "n")


STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
WS = "regexp_replace({}, '\\s+', ' ', 'g')"
WORDY = "text"
FOLDED_LOW = f"translate({WORDY}, '{FOLD_FROM}', '{FOLD_TO}')"  # a sharp s is no letter of search keys
FOLDED_UP = f"translate(replace({WORDY}, 'ß', 'ss'), '{FOLD_FROM}', '{FOLD_TO}')"


def _heads(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.col("text").alias("t"))


@query(f"""select doc_id, regexp_replace({STRIP.format(WS.format(f"upper({FOLDED_UP})"))}, '[.,;:]+$', '') as term from documents""")
def norm_term(spark, sf):
    return _heads(spark, sf).select("doc_id", N.term("t").alias("term"))


@query(f"""select doc_id, {STRIP.format(WS.format(f"regexp_replace(upper({FOLDED_UP}), '[.,;:]+$', '')"))} as norm from documents""")
def norm_plain(spark, sf):
    return _heads(spark, sf).select("doc_id", N.norm("t").alias("norm"))


@query(f"""select doc_id, {STRIP.format(f"regexp_replace(lower({FOLDED_LOW}), '[^a-z0-9]+', ' ', 'g')")} as key from documents""")
def norm_search(spark, sf):
    return _heads(spark, sf).select("doc_id", N.search_key("t").alias("key"))


@query(f"""select doc_id, regexp_replace(regexp_replace(lower({FOLDED_LOW}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from documents""")
def slugify(spark, sf):
    return _heads(spark, sf).select("doc_id", N.slug("t").alias("slug"))


@query(LEX + f""", s as (select index, body as t from lex)
select index, {STRIP.format(WS.format(f"regexp_replace({STRIP.format('upper(t)')}, '[.,;:—-]+$', '')"))} as headword, {STRIP.format("regexp_replace(upper(t), '[^A-Z ]', '', 'g')")} as letters,
{STRIP.format("regexp_replace(upper(t), '[^A-Z0-9 ]', '', 'g')")} as alnum, translate(upper(t), '!1|0Z', 'IIIOE') as ocr, regexp_replace(upper(t), '[^A-Z0-9]', '', 'g') as match_key,
upper({STRIP.format(WS.format('t'))}) as body_key, replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') as html from s""")
def other_norms(spark, sf):
    t = lexicon(spark, sf).select("index", F.col("body").alias("t"))
    return t.select("index", N.headword("t").alias("headword"), N.letters_only("t").alias("letters"), N.alnum_only("t").alias("alnum"), N.ocr_key("t").alias("ocr"), N.match_key("t").alias("match_key"), N.body_key("t").alias("body_key"), N.escape_html("t").alias("html"))


@query(LEX + """select index, case when regexp_extract(term, '[A-Z]', 0) = '' then '#' else regexp_extract(term, '[A-Z]', 0) end as filing, case when regexp_extract(term, '[A-Za-z]', 0) = '' then '?' else upper(regexp_extract(term, '[A-Za-z]', 0)) end as alpha,
case when term = '' then 'A' else upper(substr(term, 1, 1)) end as shard, upper(substr(term, 1, 1)) between 'D' and 'M' as in_range from lex""")
def filing_letter(spark, sf):
    return lexicon(spark, sf).select("index", N.filing_letter("term").alias("filing"), N.alpha_letter("term").alias("alpha"), N.shard_letter("term").alias("shard"), N.in_letters(N.shard_letter("term"), "D-M").alias("in_range"))


@query("""select o_orderkey, list_filter(list_transform([o_orderkey % 40, o_orderkey % 15], lambda x: x - 11), lambda p: p > 0) as pages, o_orderkey + 11 as leaf from orders""")
def leaf_to_page(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", N.leaf_to_page(F.array(F.col("o_orderkey") % 40, F.col("o_orderkey") % 15)).alias("pages"), N.page_to_leaf("o_orderkey").alias("leaf"))


@query("""select o_orderkey, list_filter(list_transform(string_split(concat(cast(o_orderkey as varchar), ', x,', cast(o_custkey as varchar), ' ,'), ','), lambda p: try_cast(trim(p) as int)), lambda p: p is not null) as pages from orders""")
def page_list_parse(spark, sf):
    o = table(spark, sf, "orders").withColumn("p", F.concat(F.col("o_orderkey").cast("string"), F.lit(", x,"), F.col("o_custkey").cast("string"), F.lit(" ,")))
    return o.select("o_orderkey", N.page_list("p").alias("pages"))


@query(LEX + """select index, printf('BLD2-%05d', index) as id, replace(substr(body, 1, 80), chr(10), ' ') as preview, case when index % 60 = 0 then 'clean' when index % 60 <= 5 then 'low' when index % 60 <= 50 then 'medium' else 'high' end as severity from lex""")
def stable_id(spark, sf):
    return lexicon(spark, sf).select("index", N.stable_id("index").alias("id"), N.preview("body").alias("preview"), N.severity(F.col("index") % 60).alias("severity"))


# Bodies with planted errors: every rule has something to do. SQL has no look-around, so its rules capture what stands around.
ERRORS = "' @bout &@ man @& two @ three (@ four @nd the 4nd 4ll 4n 4s 4t tbe  end', chr(10), 'a', chr(10), 'x'"
DIRTY = f"concat('@ big a@ ', body, {ERRORS})"
SQL_RULES = [
    (r"a@\s", "a "), (r"@b\b", "ab"), (r"&@\s", "a "), (r"\s@&\s", " a "), (r"\s@\s", " a "), (r"\(@\s", "(a "), (r"(\s)@([a-z])", r"\1a \2"), (r"^@([a-z])", r"a \1"),
    (r"(^|[^0-9§])4nd\b", r"\1and"), (r"(^|[^0-9§])4ll\b", r"\1all"), (r"(^|[^0-9§])4n\s", r"\1an "), (r"(^|[^0-9§])4s\s", r"\1as "), (r"(^|[^0-9§])4t\s", r"\1at "),
    (r"\n\s*a\s*\n", " a "), ("  +", " "),
]


def _sql_fold(x: str) -> str:
    for p, r in SQL_RULES:
        x = f"regexp_replace({x}, '{p}', '{r}', 'g')"
    return x


def _dirty(spark, sf):
    return lexicon(spark, sf).select("index", F.expr(DIRTY.replace("chr(10)", "'\\n'")).alias("body"))


@query(LEX + f"select index, {_sql_fold(DIRTY)} as cleaned from lex")
def clean_body(spark, sf):
    """The shipped rules, over whole bodies."""
    return C.with_rules(_dirty(spark, sf), "body", C.CLEAN_RULES).select("index", "cleaned")


def _count_sql() -> str:
    steps, x = [], "t0"
    out = f"{LEX}, t0 as (select index, {DIRTY} as t from lex)"
    for k, ((p, r), (_, _, label)) in enumerate(zip(SQL_RULES, C.CLEAN_RULES)):
        out += f", t{k + 1} as (select index, regexp_replace(t, '{p}', '{r}', 'g') as t from t{k})"
        steps.append(f"select '{label}' as label, sum(n) as hits, count(*) as rows from (select len(regexp_extract_all(t, '{p}')) as n from t{k}) where n > 0")
    return out + " select label, cast(hits as bigint) as hits, rows from (" + " union all ".join(steps) + ") where rows > 0"


@query(_count_sql())
def clean_rule_counts(spark, sf):
    return C.rule_totals(C.with_rules(_dirty(spark, sf), "body", C.CLEAN_RULES))


@query()
def clean_body_extended(spark, sf):
    """All rules, with look-behind, which SQL lacks; tested by hand-made cases."""
    return C.with_rules(_dirty(spark, sf), "body", C.EXTENDED_RULES).select("index", "cleaned", F.size("rule_hits").alias("rules"))


FLOW = r"""regexp_replace(regexp_replace(p, '\b(self|non|ex|co|re|well|quasi)-\n([a-z])', '\1-\2', 'g'), '([A-Za-z]{2,})-\n([a-z])', '\1\2', 'g')"""
KEPT = r"""regexp_replace(regexp_replace({}, '\n(\s*(—|--)\s*[A-Z]|\s*\d+[.)]\s)', chr(1) || '\1', 'g'), '\n(\s*(—|--)\s*[A-Z]|\s*\d+[.)]\s)', chr(1) || '\1', 'g')"""


@query(LEX + rf""", b as (select index, replace(concat(body, chr(10), 'judg-', chr(10), 'ment is', chr(10), '1. one', chr(10), '2) two by self-', chr(10), 'help', chr(10), chr(10), 'next  one'), '. ', chr(10)) as t from lex)
select index, array_to_string(list_transform(string_split_regex(t, '\n\n+'), lambda p: regexp_replace(regexp_replace(replace(replace({KEPT.format(FLOW)}, chr(10), ' '), chr(1), chr(10)), '  +', ' ', 'g'), '^\s+|\s+$', '', 'g')), chr(10) || chr(10)) as flowed from b""")
def reflow_paragraph(spark, sf):
    b = lexicon(spark, sf).select("index", F.replace(F.concat("body", F.lit("\njudg-\nment is\n1. one\n2) two by self-\nhelp\n\nnext  one")), F.lit(". "), F.lit("\n")).alias("t"))
    return b.select("index", C.reflow("t").alias("flowed"))


@query(LEX + r""", b as (select index, regexp_replace(concat(body, chr(10), '12', chr(10), 'mid', chr(10), 'XIV', chr(10), body, chr(10), cast(index as varchar)), '\n\s*\d{1,4}\s*\n\s*[A-Z][A-Z .''-]{1,40}\s*\n', chr(10), 'g') as t from lex),
x as (select index, i, l, min(case when regexp_matches(l, '\S') then i end) over (partition by index) as f from (select index, unnest(string_split(t, chr(10))) as l, generate_subscripts(string_split(t, chr(10)), 1) as i from b))
select index, regexp_replace(regexp_replace(string_agg(l, chr(10) order by i), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') as kept from x where i = f or not regexp_matches(l, '^\s*(\d{1,4}|[A-Z]{1,4})\s*$') group by index""")
def orphan_numerics(spark, sf):
    b = lexicon(spark, sf).select("index", F.concat("body", F.lit("\n12\nmid\nXIV\n"), "body", F.lit("\n"), F.col("index").cast("string")).alias("t"))
    return b.select("index", C.drop_orphans("t").alias("kept"))


@query(LEX + r"""select index, case when index % 3 = 0 then concat('n. ', regexp_replace(body, '^\s+', '')) when index % 3 = 1 then regexp_replace(body, '^\s+', '') when length(body) > 3 then concat('(', body) else concat(term, ' (', body) end as body from lex""")
def strip_headword(spark, sf):
    i = F.col("index") % 3
    mid = F.when(i == 0, ", n. ").when(i == 1, ". ").otherwise(" (")
    b = lexicon(spark, sf).select("index", "term", F.concat(F.col("term"), mid, F.col("body")).alias("body"))
    return b.select("index", C.strip_leading("term", "body").alias("body"))


@query(LEX + r""", b as (select index, case when index % 5 = 0 then concat('n. , ', body) when index % 5 = 1 then concat(', ', body) else body end as b0 from lex), c as (select index, regexp_replace(b0, '^\s+|\s+$', '', 'g') as b from b)
select index, length(b) < 10 or regexp_matches(regexp_replace(regexp_replace(substr(b, 1, 60), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), '^[a-z]{1,3}\. from\.|^[a-z]{1,3}\.\s*[.,;]') or regexp_matches(b, '^[,;]|^\.[ \n]') as garbled from c""")
def garbled_body(spark, sf):
    i = F.col("index") % 5
    b = lexicon(spark, sf).select("index", F.when(i == 0, F.concat(F.lit("n. , "), "body")).when(i == 1, F.concat(F.lit(", "), "body")).otherwise(F.col("body")).alias("b"))
    return b.select("index", C.garbled("b").alias("garbled"))


@query(LEX + r"""select index, length(body) >= 20 and regexp_matches(body, '[@€|]|[bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ]{5,}|[a-z][A-Z][a-z]|[A-Z]\. 8') as damaged from lex""")
def ocr_damage(spark, sf):
    return lexicon(spark, sf).select("index", C.damaged("body").alias("damaged"))


@query(r"""with b as (select p_partkey as k, p_name as a, concat(repeat('#', cast(p_partkey % 9 as int)), substr(p_name, 1 + p_partkey % 9)) as b from part)
select k, case when length(a) = 0 then a = b else abs(length(a) - length(b)) <= length(a) * 0.15::double + 10 and levenshtein(a, b) <= length(a) * 0.15::double end as accepted from b""")
def edit_ratio_gate(spark, sf):
    b = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("a"), F.expr("concat(repeat('#', cast(p_partkey % 9 as int)), substring(p_name, cast(1 + p_partkey % 9 as int)))").alias("b"))
    return b.select("k", C.edit_gate("a", "b").alias("accepted"))


@query(LEX + r"""select index, case when strpos(body, 'the') > 0 then concat(substr(body, 1, strpos(body, 'the') - 1), 'THE', substr(body, strpos(body, 'the') + 3)) else body end as fixed,
case when strpos(body, '. ') > 1 and length(rtrim(substr(body, 1, strpos(body, '. ') - 1))) > 20 then rtrim(substr(body, 1, strpos(body, '. ') - 1)) else body end as trimmed from lex""")
def apply_corrections(spark, sf):
    return lexicon(spark, sf).select("index", C.replace_first("body", F.lit("the"), F.lit("THE")).alias("fixed"), C.trim_at("body", F.lit(". ")).alias("trimmed"))


# Likeness -----------------------------------------------------------------------------------------
def _names(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.upper("p_name").alias("a"))
    return part.join(part.select((F.col("k") - 1).alias("k"), F.col("a").alias("b")), "k", "left")


PAIRS = """names as (select p.p_partkey as k, upper(p.p_name) as a, upper(q.p_name) as b from part p left join part q on q.p_partkey = p.p_partkey + 1)"""


@query(f"with {PAIRS} select k, case when length(a) = length(b) then (select coalesce(string_agg(substr(a, i::int, 1) || '->' || substr(b, i::int, 1) || ' (pos ' || (i - 1) || ')', '; ' order by i), '') from range(1, length(a) + 1) t(i) where substr(a, i::int, 1) <> substr(b, i::int, 1)) else 'length_or_complex_diff' end as diff from names")
def char_diff(spark, sf):
    return _names(spark, sf).select("k", S.char_diff("a", "b").alias("diff"))


@query(f"""with {PAIRS}, m as (select k, case when k % 3 = 0 then b when k % 3 = 1 then translate(a, 'OBEU', 'CRFV') else translate(a, 'OBEA', 'CRFX') end as c, a from names)
select k, c, length(a) = length(c) and a <> c and not exists (select 1 from range(1, length(a) + 1) t(i) where substr(a, i::int, 1) <> substr(c, i::int, 1) and substr(a, i::int, 1) || substr(c, i::int, 1) not in ({", ".join(f"'{x + y}', '{y + x}'" for x, y in S.CONFUSED)})) as confused from m""")
def confusion_only(spark, sf):
    n, k = _names(spark, sf), F.col("k") % 3
    c = F.when(k == 0, F.col("b")).when(k == 1, F.translate("a", "OBEU", "CRFV")).otherwise(F.translate("a", "OBEA", "CRFX"))
    return n.select("k", c.alias("c"), S.confusion_only("a", c).alias("confused"))


@query("""select p_partkey as k, list_sort(list_distinct(list_transform(list_filter(range(1, length(p_name) + 1), lambda i: upper(substr(p_name, i::int, 1)) = 'O'), lambda i: upper(substr(p_name, 1, (i - 1)::int)) || 'C' || upper(substr(p_name, (i + 1)::int))))) as candidates from part""")
def oc_candidates(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), S.substitutions(F.upper("p_name"), 1).alias("candidates"))


@query("""with w as (select distinct upper(unnest(string_split(p_name, ' '))) as w from part), bad as (select w as known, replace(w, 'C', 'O') as seen from w where contains(w, 'C')),
cand as (select known, seen, substr(seen, 1, i::int - 1) || 'C' || substr(seen, i::int + 1) as c from bad, range(1, 60) t(i) where i <= length(seen) and substr(seen, i::int, 1) = 'O')
select seen, min(c) as fixed from cand join w on w.w = c group by seen""")
def degarble(spark, sf):
    words = table(spark, sf, "part").select(F.explode(F.split(F.upper("p_name"), " ")).alias("w")).distinct()
    seen = words.where(F.contains("w", F.lit("C"))).select(F.replace("w", F.lit("C"), F.lit("O")).alias("seen")).distinct()
    made = seen.select("seen", F.explode(S.substitutions("seen", 1)).alias("w"))
    return made.join(words, "w", "left_semi").groupBy("seen").agg(F.min("w").alias("fixed"))


@query("""with b as (select b.item_id as k, lower(b.text) as large, regexp_replace(lower(b.text), '^\\s*\\S+\\s+', '') as small, lower(c.text) as other from benchmark b left join benchmark c on c.item_id = b.item_id + 1),
w as (select *, list_distinct(list_filter(string_split_regex(other, '\\s+'), lambda x: x <> '')) as ow, list_distinct(list_filter(string_split_regex(large, '\\s+'), lambda x: x <> '')) as lw from b)
select k, case when contains(large, small) then 1.0::double else 0.0 end as inside, case when contains(large, other) then 1.0::double when len(ow) = 0 then 0.0 else len(list_filter(ow, lambda x: list_contains(lw, x))) / len(ow)::double end as shared from w""")
def body_containment(spark, sf):
    b = table(spark, sf, "benchmark")
    c = b.select((F.col("item_id") - 1).alias("item_id"), F.lower("text").alias("other"))
    b = b.join(c, "item_id", "left").select(F.col("item_id").alias("k"), F.lower("text").alias("large"), F.regexp_replace(F.lower("text"), r"^\s*\S+\s+", "").alias("small"), "other")
    return b.select("k", S.containment("small", "large").alias("inside"), S.containment("other", "large").alias("shared"))


WORDS = LEX + """, words as (select distinct lower(regexp_extract(body, '[A-Za-z]+', 0)) as w, index % 2 as side from lex), a as (select distinct w from words where side = 0 and w <> ''), b as (select distinct w from words where side = 1 and w <> ''),
near as (select a.w as a, b.w as b, cast(levenshtein(a.w, b.w) as int) as distance from a, b where abs(length(a.w) - length(b.w)) <= 2 and levenshtein(a.w, b.w) <= 2)
"""


def _sides(spark, sf):
    w = lexicon(spark, sf).select(F.lower(F.regexp_extract("body", "[A-Za-z]+", 0)).alias("w"), (F.col("index") % 2).alias("side")).where("w <> ''")
    return w.where("side = 0"), w.where("side = 1")


@query(WORDS + "select a, arg_min(b, (distance, b)) as b, min(distance) as distance from near group by a")
def fuzzy_nearest(spark, sf):
    return J.nearest(*_sides(spark, sf), "w", 2)


@query(WORDS + "select a, b, distance from near where distance = (select min(distance) from near n where n.a = near.a)")
def fuzzy_all_ties(spark, sf):
    return J.nearest(*_sides(spark, sf), "w", 2, every_tie=True)


@query()
def near_dup_ratio(spark, sf):
    """Pairs of ratio 0.95 or more within a first letter, of names and their plurals; SQL has no such ratio (tested by brute force)."""
    names = table(spark, sf, "part").select(F.upper("p_name").alias("term"))
    return V.near_duplicates(names.unionByName(names.select(F.concat("term", F.lit("S")).alias("term"))))


@query()
def similarity_scores(spark, sf):
    """Piecewise likeness of each part's name to the next one's, and its confidence (difflib; tested by hand-made cases)."""
    return _names(spark, sf).select("k", S.similarity_score("a", "b").alias("score")).withColumn("confidence", S.confidence("score"))


@query(LEX + r""", words as (select distinct unnest(regexp_extract_all(upper(body), '[A-Z]{3,}')) as w from lex),
pairs as (select w, unnest([replace(w, 'OR', 'OUR'), replace(w, 'IZE', 'ISE'), replace(w, 'AE', 'E'), replace(w, 'E', 'OE'), w || 'S', w || 'MENT', w || 'XX', substr(w, 1, length(w) - 2)]) as other from words),
flat as (select distinct *, regexp_replace(replace(replace(w, 'OUR', 'OR'), 'ISE', 'IZE'), '(AE|OE)', 'E', 'g') as fw, regexp_replace(replace(replace(other, 'OUR', 'OR'), 'ISE', 'IZE'), '(AE|OE)', 'E', 'g') as fo, case when length(w) <= length(other) then w else other end as short, case when length(w) <= length(other) then other else w end as long from pairs)
select w, other, w <> other and fw = fo as variant, starts_with(long, short) and regexp_matches(substr(long, length(short) + 1), '^(S|ES|ED|ING|ER|OR|ION|MENT|LY|AL|ABLE|NESS)$') as derived from flat""")
def spelling_kinds(spark, sf):
    """Every word of the bodies against eight words made from it, whether these are variants or derived."""
    w = F.col("w")
    words = lexicon(spark, sf).select(F.explode(F.array_distinct(F.regexp_extract_all(F.upper("body"), F.lit("[A-Z]{3,}"), F.lit(0)))).alias("w")).distinct()
    changed = [F.replace(w, F.lit(x), F.lit(y)) for x, y in (("OR", "OUR"), ("IZE", "ISE"), ("AE", "E"), ("E", "OE"))]
    made = F.array_distinct(F.array(*changed, *(F.concat(w, F.lit(x)) for x in ("S", "MENT", "XX")), F.expr("substring(w, 1, length(w) - 2)")))
    return words.select("w", F.explode(made).alias("other")).select("w", "other", S.variant_spelling("w", "other").alias("variant"), S.derivational("w", "other").alias("derived"))
