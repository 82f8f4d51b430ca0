"""Queries of audits, the overlay, recovery, layout, segmentation and alignment."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import audit as V
from ..operators import overlay as O
from ..operators import segment as G
from ..operators.scan import settled
from ..sources import io
from .lexicon import SQL, lexicon, table
from .registry import ORACLES, query

LEX = f"with {SQL}"
# Headwords of every doubtful kind, made from the index.
ODD_SQL = """case when index % 9 = 0 then 'B' when index % 9 = 1 then concat(term, ' (X)') when index % 9 = 2 then concat(term, '.X') when index % 9 = 3 then concat('12 ', term, ' ') when index % 9 = 4 then 'A. B. C.' when index % 9 = 5 then 'A' else term end"""


def _odd():
    i, t = F.col("index") % 9, F.col("term")
    return F.when(i == 0, "B").when(i == 1, F.concat(t, F.lit(" (X)"))).when(i == 2, F.concat(t, F.lit(".X"))).when(i == 3, F.concat(F.lit("12 "), t, F.lit(" "))).when(i == 4, "A. B. C.").when(i == 5, "A").otherwise(t)


@query(LEX + rf""", o as (select index, {ODD_SQL} as term from lex), r as (select index, term, list_sort(list_filter([
case when length(term) = 1 and term <> 'A' then 'single_letter' end, case when length(term) < 2 and term <> 'A' then 'too_short' end, case when regexp_matches(term, '[();]') then 'embedded_punctuation' end,
case when contains(term, '.') and not regexp_matches(term, '^[A-Z]{{1,4}}\.\s*$|^[A-Z]\.[A-Z]') and not regexp_matches(term, '^[A-Z]\.\s*[A-Z]\.') then 'suspicious_period' end,
case when regexp_matches(term, '^\d+\s+([A-Z]|[A-Za-z]+\.)\s') then 'citation_fragment' end], lambda x: x is not null)) as reasons from o)
select index, term, array_to_string(reasons, ',') as reasons from r where len(reasons) > 0""")
def audit_suspicious(spark, sf):
    t = lexicon(spark, sf).select("index", _odd().alias("term")).withColumn("r", V.suspicious_headword(F.col("term")))
    return t.where(F.size("r") > 0).select("index", "term", F.array_join("r", ",").alias("reasons"))


@query(LEX + r""", b as (select index, term, case when index % 3 = 0 then concat(upper(substr(body, 1, 12)), ' x') else body end as body from lex)
select index, regexp_extract(body, '^([A-Z]{3,})', 1) as caps from b where not regexp_matches(body, '(?i)^(In |Lat\.|adj\.|v\.|n\.|Fr\.|Sp\.|Sax\.|Eng\.)') and regexp_matches(body, '^([A-Z]{3,})') and regexp_extract(body, '^([A-Z]{3,})', 1) <> term and not starts_with(term, regexp_extract(body, '^([A-Z]{3,})', 1))
union all select -1, 'none'""")
def audit_boundary(spark, sf):
    b = lexicon(spark, sf).withColumn("body", F.when(F.col("index") % 3 == 0, F.concat(F.upper(F.substring("body", 1, 12)), F.lit(" x"))).otherwise(F.col("body")))
    none = spark.range(1).select(F.lit(-1).cast("long").alias("index"), F.lit("none").alias("caps"))
    return b.select("index", V.boundary(F.col("term"), F.col("body")).alias("caps")).where("caps is not null").unionByName(none)


@query(LEX + "select index, length(trim(b)) as n from (select index, case when index % 3 = 0 then concat(repeat('x', cast(index % 40 as int)), '  ') else body end as b from lex) where length(trim(b)) < 20")
def audit_near_empty(spark, sf):
    b = lexicon(spark, sf).select("index", F.expr("case when index % 3 = 0 then concat(repeat('x', cast(index % 40 as int)), '  ') else body end").alias("b"))
    return b.where(V.near_empty(F.col("b"))).select("index", F.length(F.trim("b")).cast("long").alias("n"))


@query(LEX + r"select index, len(regexp_extract_all(replace(body, '. ', ' ' || chr(10)) || chr(10), '[A-Za-z] ?\n')) as line_ends, len(regexp_extract_all(replace(body, ' ', chr(10)), '[A-Za-z]\n')) >= 0 as ok from lex")
def audit_line_ends(spark, sf):
    b = lexicon(spark, sf)
    t = F.concat(F.replace("body", F.lit(". "), F.lit(" \n")), F.lit("\n"))
    return b.select("index", F.regexp_count(t, F.lit(r"[A-Za-z] ?\n")).cast("long").alias("line_ends"), (V.reflow_pairs(F.replace("body", F.lit(" "), F.lit("\n"))) >= 0).alias("ok"))


@query(LEX + r""", l as (select index, i, line, lead(line) over (partition by index order by i) as nxt from (select index, unnest(string_split(replace(body, ', ', chr(10)), chr(10))) as line, generate_subscripts(string_split(replace(body, ', ', chr(10)), chr(10)), 1) as i from lex))
select index, count(*) as pairs from l where regexp_matches(line, '[A-Za-z]$') and regexp_matches(nxt, '^[a-z]') group by index""")
def audit_reflow(spark, sf):
    b = lexicon(spark, sf).select("index", V.reflow_pairs(F.replace("body", F.lit(", "), F.lit("\n"))).cast("long").alias("pairs"))
    return b.where("pairs > 0")


@query(LEX + r""", b as (select index, concat(body, case when index % 2 = 0 then ' the 4th 4nd 4ll, 7x; (5s) a4t, x-4n @' else ' 12th ' end) as body from lex),
d as (select index, list_filter(regexp_extract_all(regexp_replace(body, '([\s,;.)])', '\1\1', 'g'), '(?:^|[^0-9§–,./#:-])(\d[a-z]{1,3})(?:[\s,;.)])', 1), lambda x: not regexp_matches(x, '^\d+(st|nd|rd|th|d|s)$')) as odd, contains(body, '@') as at_sign from b)
select index, array_to_string(case when at_sign then list_append(odd, '@') else odd end, ' ') as found from d where len(odd) > 0 or at_sign""")
def audit_ocr(spark, sf):
    extra = F.when(F.col("index") % 2 == 0, " the 4th 4nd 4ll, 7x; (5s) a4t, x-4n @").otherwise(" 12th ")
    b = lexicon(spark, sf).select("index", V.ocr_artifacts(F.concat("body", extra)).alias("odd"))
    return b.where(F.size("odd") > 0).select("index", F.array_join("odd", " ").alias("found"))


@query("""with p as (select o_orderkey as k, case when o_orderkey % 7 = 0 then null when o_orderkey % 7 = 1 then [] when o_orderkey % 7 = 2 then ['x', '3'] else [cast(o_orderkey % 1500 as varchar), '5'] end as pages from orders)
select k, case when pages is null then 'missing' when len(pages) = 0 then 'empty' when len(list_filter(pages, lambda x: try_cast(x as int) is null)) > 0 then 'non_numeric' when len(list_filter(pages, lambda x: try_cast(x as int) < 1 or try_cast(x as int) > 1238)) > 0 then 'out_of_range' end as problem from p""")
def audit_pages(spark, sf):
    k = F.col("o_orderkey")
    pages = F.when(k % 7 == 0, None).when(k % 7 == 1, F.array().cast("array<string>")).when(k % 7 == 2, F.array(F.lit("x"), F.lit("3"))).otherwise(F.array((k % 1500).cast("string"), F.lit("5")))
    return table(spark, sf, "orders").select(k.alias("k"), V.page_problem(pages).alias("problem"))


ENTRY = """e as (select index, term, case when index % 11 = 0 then '' else body end as body, case when index % 7 = 1 then ['0'] else [cast(page as varchar)] end as source_pages from lex)"""


def _entries(spark, sf):
    lex = lexicon(spark, sf)
    body = F.when(F.col("index") % 11 == 0, "").otherwise(F.col("body"))
    return lex.select("index", "term", body.alias("body"), F.when(F.col("index") % 7 == 1, F.array(F.lit("0"))).otherwise(F.array(F.col("page").cast("string"))).alias("source_pages"))


@query(LEX + r""", """ + ENTRY + r""", d as (select term from e group by term having count(*) > 1)
select 'duplicate_term' as check, 'error' as level, count(*) as n from d union all select 'empty_body', 'error', count(*) from e where trim(body) = '' or regexp_matches(body, '^[\s[:punct:]]+$')
union all select 'pages', 'warning', count(*) from e where index % 7 = 1
union all select 'reflow', 'warning', count(*) from e where regexp_matches(body, '[A-Za-z]\n[a-z]') having count(*) > 0
union all select 'garbled_start', 'warning', count(*) from (select regexp_replace(body, '^\s+|\s+$', '', 'g') as b from e) where length(b) < 10 or regexp_matches(regexp_replace(regexp_replace(substr(b, 1, 60), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), '^[a-z]{1,3}\. from\.|^[a-z]{1,3}\.\s*[.,;]') or regexp_matches(b, '^[,;]|^\.[ \n]')""")
def validate_summary(spark, sf):
    rows = V.validate(_entries(spark, sf).drop("index"))
    return rows.where(F.col("check").isin("duplicate_term", "empty_body", "pages", "reflow", "garbled_start")).groupBy("check", "level").agg(F.count("*").alias("n"))


@query(LEX + """, a as (select case when term = '' then 'A' else upper(substr(term, 1, 1)) end as letter, count(*) as have from lex where regexp_matches(case when term = '' then 'A' else upper(substr(term, 1, 1)) end, '^[A-Z]$') group by 1),
b as (select letter, have + (ascii(letter) % 2) as count from a) select letter, have, count from a join b using (letter) where have <> count""")
def audit_manifest(spark, sf):
    have = io.manifest(lexicon(spark, sf)).select("letter", F.col("count").alias("have"))
    return have.withColumn("count", F.col("have") + F.ascii("letter") % 2).where("have <> count")


@query(LEX + """, live as (select distinct term from lex where index % 5 <> 0), w as (select distinct term from lex where entry_type in ('verified_main', 'unmatched_keep')), known as (select distinct term from lex where entry_type <> 'fragment_artifact')
select term, 'missing_from_live' as problem from w where term not in (select term from live) union all select term, 'not_in_overlay' from live where term not in (select term from known)""")
def audit_accounting(spark, sf):
    lex = lexicon(spark, sf)
    return V.accounting(lex, lex.where("index % 5 <> 0"))


@query(LEX + """, live as (select distinct term from lex where index % 2 = 0), first as (select term, arg_min(entry_type, index) as entry_type from lex where index % 3 = 0 group by term), want as (select distinct term, case when length(term) % 2 = 0 then 'live' else 'suppressed' end as expectation from lex where index % 10 < 4),
s as (select w.term, w.expectation, case when l.term is not null then 'live' when f.term is not null then 'suppressed' else 'absent' end as status from want w left join live l on l.term = w.term left join first f on f.term = w.term)
select term, expectation, status, status = expectation as as_expected from s""")
def probe_status(spark, sf):
    lex = lexicon(spark, sf)
    want = lex.where("index % 10 < 4").select("term", F.when(F.length("term") % 2 == 0, "live").otherwise("suppressed").alias("expectation")).distinct()
    return V.probes(want, lex.where("index % 2 = 0"), lex.where("index % 3 = 0"))


@query(LEX + r""", b as (select index, term, case when index % 4 = 0 then '' when index % 4 = 1 then concat('x', chr(10), '12', chr(10), 'XIV', chr(10), 'BAIL BOND. y') else body end as body, case when index % 3 = 0 then null when index % 3 = 1 then term else 'Z' end as src, cast(index % 5 - 2 as double) as score from lex)
select index, array_to_string(list_sort(list_filter([case when trim(body) = '' then 'empty_body' end, case when regexp_matches(body, '(?m)^\d{1,4}$') then 'page_number_artifact' end, case when regexp_matches(regexp_replace(body, '^[^\n]*\n?', ''), '(?m)^[A-Z]{1,4}$') then 'short_header_artifact' end,
case when src is null then 'missing_source_candidate' end, case when src is not null and src <> term then 'headword_mismatch' end, case when regexp_matches(body, '(?m)^[A-Z][A-Z0-9 ''&().,-]{4,}\.(?:\s|$)') then 'embedded_caps_subentry' end, case when length(body) < 40 then 'short_body' end, case when score <= 0 then 'low_match_score' end], lambda x: x is not null)), ',') as flags from b""")
def build_flags(spark, sf):
    i = F.col("index")
    body = F.when(i % 4 == 0, "").when(i % 4 == 1, "x\n12\nXIV\nBAIL BOND. y").otherwise(F.col("body"))
    src = F.when(i % 3 == 0, None).when(i % 3 == 1, F.col("term")).otherwise("Z")
    return lexicon(spark, sf).select("index", F.array_join(V.build_flags(F.col("term"), body, src, (i % 5 - 2).cast("double")), ",").alias("flags"))


CITING = r"""case when index % 5 = 0 then concat('See ', term, '.') when index % 5 = 1 then concat('Smith v. Jones. ', body) when index % 5 = 2 then concat('A tax is Smith v. Jones ', body) when index % 5 = 3 then 'Doe' || chr(10) || 'v. Roe v. Poe. 1 v. X' else body end"""


@query(LEX + rf""", b as (select index, {CITING} as b from lex), c as (select index, b, len(regexp_extract_all(b, '(?i)([A-Z][a-z]+(?:.+?)?)\s+v\.\s+[A-Z]')) as cites from b)
select index, case when length(b) < 80 and regexp_matches(b, '^(See|Cf\.) ') then case when trim(regexp_replace(b, '(?i)^(See|Cf\.)\s+[A-Z\s,]+[.;]\s*', '')) = '' then 'short_see' end
when cites > 0 and not regexp_matches(b, '(?i)\b(is|means|denotes|signifies|a\s+.*?\s+who)\b') and (length(b) < 400 or cites >= 2) then 'court_cites_no_def' end as phantom from c""")
def phantom_candidates(spark, sf):
    return lexicon(spark, sf).select("index", V.phantom(F.expr(CITING.replace("chr(10)", "'\\n'"))).alias("phantom"))


@query(LEX + rf""", o as (select index, {ODD_SQL} as term, body from lex) select index, regexp_matches(term, '^(?:[A-Z]\.){{1,6}}(?:\s*[&]\s*(?:[A-Z]\.){{1,4}})?$|^[A-Z]\.\s*[A-Z]\.$|^[A-Z]\.[A-Z&]\.|^[A-Z]\.[&)(\]]|^[A-Z]\.[A-Z]$') as abbreviation,
regexp_matches(regexp_replace(term, '[.,;:]+$', ''), '^\d+$|^[IVXLCDM]{{1,6}}$') or length(regexp_replace(term, '[.,;:]+$', '')) < 2 as junk, regexp_matches(term, '^[A-Z]{{1,4}}$') or (regexp_matches(term, '^[A-Za-z]{{1,5}}$') and not regexp_matches(term, '^[AEIOUaeiou]')) as fragment,
case when length(body) < 50 then 'fragment' when length(body) < 100 then 'short' else 'normal' end as size from o""")
def headword_kinds(spark, sf):
    t = lexicon(spark, sf).select("index", _odd().alias("term"), "body")
    return t.select("index", V.abbreviation(F.col("term")).alias("abbreviation"), V.junk(F.col("term")).alias("junk"), V.fragment(F.col("term")).alias("fragment"), V.unverified(F.col("body")).alias("size"))


@query()
def near_dup_pairs(spark, sf):
    """Pairs of ratio 0.95 or more among all headwords and misread ones (difflib; long ones and others tested by brute force)."""
    heads = lexicon(spark, sf).select("term")
    return V.near_duplicates(heads.unionByName(heads.select(F.concat("term", F.lit("S")).alias("term"))))


@query(LEX + """, h as (select distinct term as w from lex where length(term) >= 4) select a.w as a, b.w as b, cast(levenshtein(a.w, b.w) as int) as distance from h a join h b on a.w < b.w and abs(length(a.w) - length(b.w)) <= 1 and levenshtein(a.w, b.w) <= 1""")
def near_dup_lev(spark, sf):
    from ..operators import joins as J

    return J.within(lexicon(spark, sf).where("length(term) >= 4").select(F.col("term").alias("w")), "w", 1)


# Overlay ------------------------------------------------------------------------------------------
BUILD = """o as (select index, term, entry_type, case when index % 6 = 0 then concat('old ', term) end as original_term, case when index % 10 = 0 then 'manual body' end as manual, case when index % 3 = 0 then null else term end as source_headword,
 index % 7 = 0 as flagged, case when index % 4 = 0 then '' when index % 4 = 1 then concat('n. , ', body) else body end as rebuilt, case when index % 5 = 0 then null when index % 5 < 3 then repeat('l', cast(index % 90 as int)) else body end as legacy from lex),
p as (select *, trim(coalesce(rebuilt, '')) as rb, trim(coalesce(legacy, '')) as lb from o),
q as (select *, not flagged and rb <> '' and not (length(regexp_replace(rb, '^\\s+|\\s+$', '', 'g')) < 10 or regexp_matches(regexp_replace(rb, '\\s+', ' ', 'g'), '^\\s*[a-z]{1,3}\\. from\\.|^\\s*[a-z]{1,3}\\.\\s*[.,;]') or regexp_matches(regexp_replace(rb, '^\\s+', ''), '^[,;]|^\\.[ \\n]')) as usable from p),
picked as (select *, case when manual is not null then 'manual_correction' when source_headword is not null and usable then 'rebuilt' when lb <> '' then 'legacy' when rb <> '' then 'rebuilt_garbled' else 'empty' end as body_source from q)
"""


def _overlay(spark, sf):
    i = F.col("index")
    return lexicon(spark, sf).select(
        "index", "term", "entry_type", F.when(i % 6 == 0, F.concat(F.lit("old "), "term")).alias("original_term"), F.when(i % 10 == 0, "manual body").alias("manual"), F.when(i % 3 != 0, F.col("term")).alias("source_headword"),
        (i % 7 == 0).alias("flagged"), F.when(i % 4 == 0, "").when(i % 4 == 1, F.concat(F.lit("n. , "), "body")).otherwise(F.col("body")).alias("rebuilt"), F.expr("case when index % 5 = 0 then null when index % 5 < 3 then repeat('l', cast(index % 90 as int)) else body end").alias("legacy"),
    )


@query(LEX + f", {BUILD} select index, body_source, case body_source when 'manual_correction' then manual when 'legacy' then lb when 'empty' then '' else rb end as body from picked")
def pick_body(spark, sf):
    return O.pick_body(_overlay(spark, sf)).select("index", "body_source", "body")


@query(LEX + f", {BUILD} select case when entry_type = 'legacy_unresolved' then 'legacy_retained' else entry_type end as live_type, body_source, count(*) as n from picked where entry_type in ('verified_main', 'unmatched_keep') or (entry_type = 'legacy_unresolved' and length(lb) >= 40) group by all")
def live_build(spark, sf):
    return O.live_build(_overlay(spark, sf)).groupBy("live_type", "body_source").agg(F.count("*").alias("n"))


@query(LEX + """, a as (select index, term, body from lex), b as (select index, term, case when index % 13 = 0 then concat(body, '!') else body end as body from lex where index % 17 <> 0)
select a.index, length(a.body) as old_n, length(b.body) as new_n from a join b using (index) where a.body is distinct from b.body""")
def split_live_diff(spark, sf):
    from ..operators import joins as J

    a = lexicon(spark, sf).select("index", "term", "body")
    b = a.where("index % 17 <> 0").withColumn("body", F.when(F.col("index") % 13 == 0, F.concat("body", F.lit("!"))).otherwise(F.col("body")))
    return J.changed(a, b, "index", ["body"]).select("index", F.length("old_body").cast("long").alias("old_n"), F.length("new_body").cast("long").alias("new_n"))


CORR = """c as (select index, case index % 4 when 0 then 'ocr_fix' when 1 then 'trim' when 2 then 'headword' else 'ocr_fix' end as type, case when index % 9 = 0 then 'NO SUCH' else cast(index as varchar) end as term, case when index % 8 = 3 then 'shew the' when index % 16 = 7 then 'Nisi  Prius' else 'the' end as old, 'THE' as new, '. ' as trim_at from lex where index % 3 = 0),
e as (select cast(index as varchar) as term, body from lex)"""


def _corrections(spark, sf):
    i = F.col("index")
    lex = lexicon(spark, sf)
    kind = F.when(i % 4 == 0, "ocr_fix").when(i % 4 == 1, "trim").when(i % 4 == 2, "headword").otherwise("ocr_fix")
    c = lex.where("index % 3 = 0").select("index", kind.alias("type"), F.when(i % 9 == 0, "NO SUCH").otherwise(i.cast("string")).alias("term"), F.when(i % 8 == 3, "shew the").when(i % 16 == 7, "Nisi  Prius").otherwise("the").alias("old"), F.lit("THE").alias("new"), F.lit(". ").alias("trim_at"))
    return O.route_corrections(c, lex.select(i.cast("string").alias("term"), "body"))


@query(LEX + f""", {CORR} select type, outcome, count(*) as n from (select c.type, case when e.body is null then 'failed' when type = 'ocr_fix' then case when contains(old, 'shew') or contains(old, 'Nisi') then 'rejected' when not contains(body, old) then 'failed' else 'accepted' end
when type = 'trim' then case when strpos(body, trim_at) > 1 and length(rtrim(substr(body, 1, strpos(body, trim_at) - 1))) > 20 then 'accepted' else 'failed' end when type in ('headword', 'flag') then 'flagged' else 'failed' end as outcome from c left join e using (term)) group by all""")
def correction_router(spark, sf):
    return _corrections(spark, sf).groupBy("type", "outcome").agg(F.count("*").alias("n"))


@query(LEX + """, f as (select term, arg_max(case when index % 3 = 0 then term when index % 3 = 1 then concat(term, 'S') else upper(split_part(term, ' ', 1)) end, index) as suggested from lex where index % 5 < 3 group by term), k as (select distinct term from lex where index % 7 <> 0), live as (select distinct term from lex where index % 2 = 0)
select f.term, f.suggested, case when k.term is null then 'skip' when f.suggested = f.term then 'skip' when l.term is not null then 'suppress' else 'correct' end as action from f left join k on k.term = f.term left join live l on l.term = f.suggested""")
def flag_resolution(spark, sf):
    lex, i = lexicon(spark, sf), F.col("index")
    s = F.when(i % 3 == 0, F.col("term")).when(i % 3 == 1, F.concat("term", F.lit("S"))).otherwise(F.upper(F.split_part("term", F.lit(" "), F.lit(1))))
    return O.resolve_flags(lex.where("index % 5 < 3").select("term", i.alias("position"), s.alias("suggested")), lex.where("index % 7 <> 0"), lex.where("index % 2 = 0"))


@query(LEX + """, known as (select w as term, count(*) as n from (select unnest(regexp_extract_all(upper(body), '[A-Z]+')) as w from lex where index % 2 = 0) group by w),
op as (select index, replace(regexp_extract(term, '^[A-Z]+', 0), 'C', 'O') as term from lex where entry_type = 'legacy_unresolved'), taken as (select distinct term from op),
made as (select index, term, substr(term, 1, i::int - 1) || 'C' || substr(term, i::int + 1) as corrected from op, range(1, 60) t(i) where i <= length(term) and substr(term, i::int, 1) = 'O'),
best as (select index, term, arg_min(corrected, (-n, corrected)) as corrected from made join known on known.term = made.corrected where corrected not in (select term from taken) group by index, made.term)
select index, term, corrected from (select *, row_number() over (partition by corrected order by index) as r from best) where r = 1""".replace("(select index, term, arg_min", "(select index, made.term as term, arg_min"))
def ocr_headword_fix(spark, sf):
    from ..operators.aggregate import word_frequency

    lex = lexicon(spark, sf)
    known = word_frequency(lex.where("index % 2 = 0"), "body").withColumnRenamed("word", "term")
    over = lex.where("entry_type = 'legacy_unresolved'").select("index", F.replace(F.regexp_extract("term", "^[A-Z]+", 0), F.lit("C"), F.lit("O")).alias("term"), "entry_type")
    return O.correct_headwords(over, known)


@query(LEX + """, b as (select 1 as version, count(*) as now, count(*) as reported from lex where index % 4 <> 0 union all select 2, count(*), null from lex union all select 3, count(*), count(*) - 1 from lex union all select 4, count(*), count(*) from lex where index % 2 = 0)
select version::bigint as version, now, lag(now) over (order by version) as before, now - lag(now) over (order by version) as delta, case when lag(now) over (order by version) is null then 'first_build' when now = lag(now) over (order by version) then 'same' when reported = now then 'explained' else 'unexplained' end as verdict from b""")
def build_history(spark, sf):
    """Four builds of the lexicon, committed one after the other, and how their counts changed."""
    from ..operators.scan import shared_folder
    from ..sources import history as H

    lex, folder = lexicon(spark, sf).select("index", "term"), f"{shared_folder(spark)}/history-{uuid.uuid4().hex}"
    all_, half = lex.count(), lex.where("index % 2 = 0").count()
    for build, reported in ((lex.where("index % 4 <> 0"), lex.where("index % 4 <> 0").count()), (lex, None), (lex, all_ - 1), (lex.where("index % 2 = 0"), half)):
        H.commit(build, folder, reported)
    return H.changes(spark, folder)


@query()
def misread_headwords(spark, sf):
    """Unresolved headwords, spoiled, that are duplicates of live entries or corrected in turn (difflib; tested by brute force)."""
    lex, i = lexicon(spark, sf), F.col("index")
    garbled = F.when(i % 2 == 0, F.replace("term", F.lit("C"), F.lit("O"))).otherwise(F.replace("term", F.lit("N"), F.lit("M")))
    return O.settle_headwords(lex.where("entry_type <> 'verified_main'").select("index", garbled.alias("term"), "body"), lex.where("entry_type = 'verified_main'").select("term", "body"))


@query()
def overlay_classify(spark, sf):
    """The waterfall of entry types (difflib ratios inside; tested by hand-made cases)."""
    lex, i = lexicon(spark, sf), F.col("index")
    e = lex.select("index", "term", "body", F.when(i % 3 == 0, F.col("term")).alias("source_headword"), ((i % 10) / 10.0).alias("confidence"))
    manual = lex.where("index % 50 = 1").select("term", F.lit("alias_variant").alias("kind"), F.lit("X").alias("target"))
    dupes = lex.where("index % 8 = 5").select("term", F.concat("term", F.lit("S")).alias("closest"), F.col("body").alias("closest_body"))
    out = O.classify(e, manual, lex.where("index % 4 = 2").select("term", "body"), dupes, lex.where("index % 9 = 2").select("term"))
    return out.groupBy("entry_type", "reason").agg(F.count("*").alias("n"))


@query()
def body_oracle(spark, sf):
    """Verdicts of what bodies begin with (difflib ratios inside; tested by hand-made cases)."""
    lex = lexicon(spark, sf)
    return O.body_oracle(lex.select("index", "term", F.concat("term", F.lit(". "), "body").alias("body"))).groupBy("verdict").agg(F.count("*").alias("n"))


@query(LEX + """, m as (select distinct regexp_extract(lower(body), '[a-z]+', 0) as term from lex where index % 3 = 0), a as (select distinct regexp_extract(lower(body), '[a-z]+', 0) as term from lex where index % 3 = 1), b as (select distinct regexp_extract(lower(body), '[a-z]+', 0) as term from lex where index % 3 = 2),
n as (select m.term, b.term as match, cast(levenshtein(m.term, b.term) as int) as d, row_number() over (partition by m.term order by levenshtein(m.term, b.term), b.term) as r from m, b where levenshtein(m.term, b.term) <= 2)
select m.term, case when a.term is not null then 'overlay' when n.term is not null then 'candidates' end as found_in, coalesce(a.term, n.match) as match, case when a.term is not null then 0 else n.d end as distance from m left join a on a.term = m.term left join n on n.term = m.term and n.r = 1""")
def recovery_cascade(spark, sf):
    lex = lexicon(spark, sf).select("index", F.regexp_extract(F.lower("body"), "[a-z]+", 0).alias("term"))
    return O.cascade(lex.where("index % 3 = 0"), [("overlay", lex.where("index % 3 = 1")), ("candidates", lex.where("index % 3 = 2"))], 2, ("candidates",))


@query(LEX + """, t as (select index, term, case when index % 6 = 0 then '' else body end as b, case when index % 3 = 0 then concat(body, ' and more') when index % 3 = 1 then concat(upper(body), ' x') end as pb from lex),
s as (select *, case when contains(pb, b) then 1.0::double when len(list_distinct(list_filter(string_split_regex(b, '\\s+'), lambda w: w <> ''))) = 0 then 0.0 else len(list_filter(list_distinct(list_filter(string_split_regex(b, '\\s+'), lambda w: w <> '')), lambda w: list_contains(string_split_regex(pb, '\\s+'), w))) / len(list_distinct(list_filter(string_split_regex(b, '\\s+'), lambda w: w <> '')))::double end as share from t)
select index, case when trim(b) = '' then 'no_body' when pb is not null and share > 0.95 then 'duplicate' when pb is not null and share > 0.85 then 'subentry' else 'standalone' end as triage from s""")
def prefix_triage(spark, sf):
    i = F.col("index")
    t = lexicon(spark, sf).select("index", "term", F.when(i % 6 == 0, "").otherwise(F.col("body")).alias("body"), F.when(i % 3 == 0, F.concat("body", F.lit(" and more"))).when(i % 3 == 1, F.concat(F.upper("body"), F.lit(" x"))).alias("parent_body"))
    return O.prefix_triage(t).select("index", "triage")


NEAR_EMPTY_SQL = r""", e as (select index, term, page, case index % 12 when 0 then concat('See ', term, '.') when 1 then 'See X' when 2 then ' see zzqqy;' when 3 then 'A dairy.' when 4 then 'x' when 5 then 'half-' when 6 then '' when 7 then concat('(see ', substr(term, 1, 4), ' zz') when 8 then 'Abc def' when 9 then '12.' when 10 then 'as Cowell x' else 'See foo-' end as body, case when index % 5 < 3 then page end as leaf from lex),
n as (select *, regexp_replace(body, '^\s+|\s+$', '', 'g') as b, trim(regexp_replace(upper(term), '[^A-Z ]', '', 'g')) as key from e),
near as (select *, length(b) as n, regexp_replace(b, '^[^A-Za-z]*', '') as bare from n where length(b) < 20),
see as (select *, starts_with(lower(bare), 'see ') as is_see, case when starts_with(lower(bare), 'see ') then regexp_replace(trim(regexp_extract(bare, '^[Ss][Ee][Ee]\s+(.+)', 1)), '[.,;:\s]+$', '') end as target from near),
cleaned as (select *, trim(regexp_replace(upper(target), '[^A-Z ,\-]', '', 'g')) as clean, regexp_split_to_array(trim(regexp_replace(upper(target), '[^A-Z ,\-]', '', 'g')), '\s+')[1] as word from see),
heads as (select distinct upper(term) as h from e),
cand as (select trim(regexp_replace(upper(term), '[^A-Z ]', '', 'g')) as key, max(length(body)) as l from lex where index % 4 = 0 group by 1),
lp as (select trim(regexp_replace(upper(term), '[^A-Z ]', '', 'g')) as key, max(length(body)) as l from lex where index % 4 = 1 group by 1),
found as (select c.index, string_split(regexp_replace(substr(p.body, instr(upper(p.body), upper(c.term)) + length(c.term)), '^\s+|\s+$', '', 'g'), chr(10)) as ls from cleaned c join lex p on p.page = c.leaf where instr(upper(p.body), upper(c.term)) > 0),
stops as (select *, coalesce((select min(i) from range(2, len(ls) + 1) t(i) where length(trim(ls[i])) > 3 and trim(ls[i]) = upper(trim(ls[i]))), len(ls) + 1) as stop from found),
pages as (select index, max(l) as l from (select index, length(regexp_replace(regexp_replace(regexp_replace(array_to_string(ls[1:stop - 1], chr(10)), '^\s+|\s+$', '', 'g'), '^[.,;:\-—\s]+', ''), '^\s+|\s+$', '', 'g')) as l from stops) where l > 20 group by index),
j as (select c.*, cand.l as cl, pages.l as pl, lp.l as ll, case when is_see then 0 else 10 end as spare, clean in (select h from heads) as head, length(word) >= 3 and exists (select 1 from heads where starts_with(h, word)) as begins from cleaned c left join cand on cand.key = c.key and c.key <> '' left join pages on pages.index = c.index left join lp on lp.key = c.key and c.key <> ''),
t as (select *, case when cl > n + spare then cl when pl > n + spare then pl end as djvu, case when ll > n + spare then ll end as other from j),
o as (select *, case when djvu is not null then 'djvu_recovered' when other is not null then 'lp_recovered' end as taken from t),
r as (select *, case when term in (select term from lex where index % 13 = 0) then 'reviewed_ok'
 when is_see then case when b like '%-' or (length(target) > 0 and length(target) < 3) then coalesce(taken, 'see_ref_truncated') when target = '' then 'see_ref_truncated' when head or begins then 'see_ref_valid' else 'see_ref_unresolved' end
 when (regexp_matches(b, '^(Lat\.\s+|L\.\s+Fr\.\s+)?[A-Z].*[.)]$') and n >= 7) or regexp_matches(b, '\b(Cowell|Blount|Jacob|Spelman|Johnson|Du Cange)\b') or regexp_matches(b, '^(Lat\.|L\. Fr\.)\s+') or regexp_matches(b, '\((q|g)\. v\.\)|\(q\.v\.\)') then 'reviewed_ok'
 when taken is not null then taken when regexp_matches(b, '^\p{Ll}') or (n < 7 and b not like '%.') or regexp_matches(b, '^[^\p{Lu}\d]') then 'truncated_body' when n < 5 then 'empty_stub' else 'reviewed_ok' end as outcome from o)
select index, outcome, case outcome when 'djvu_recovered' then djvu when 'lp_recovered' then other end as new_chars from r"""


@query(LEX + NEAR_EMPTY_SQL)
def near_empty_triage(spark, sf):
    """Entries whose bodies were emptied in twelve ways; whole bodies are the sources that recover them."""
    lex, i = lexicon(spark, sf), F.col("index") % 12
    made = F.when(i == 0, F.concat(F.lit("See "), "term", F.lit("."))).when(i == 1, "See X").when(i == 2, " see zzqqy;").when(i == 3, "A dairy.").when(i == 4, "x").when(i == 5, "half-").when(i == 6, "")
    made = made.when(i == 7, F.concat(F.lit("(see "), F.substring("term", 1, 4), F.lit(" zz"))).when(i == 8, "Abc def").when(i == 9, "12.").when(i == 10, "as Cowell x").otherwise("See foo-")
    on = F.when(F.col("index") % 5 < 3, F.array(F.col("page").cast("string"))).otherwise(F.array().cast("array<string>"))
    entries = lex.select("index", "term", made.alias("body"), on.alias("source_pages"))
    once = lexicon(spark, sf, labelled=False)  # of several bodies the longest counts, so labels, which only repeat rows, need not meet bodies
    out = O.near_empty_triage(entries, once.where("index % 13 = 0"), once.where("index % 4 = 0"), once.select(F.col("page").alias("leaf"), F.col("body").alias("text")), once.where("index % 4 = 1"))
    return out.select("index", "outcome", F.length("new_body").cast("long").alias("new_chars"))


@query(LEX + """, e as (select index, case when index % 3 = 0 then replace(regexp_extract(upper(body), '^[A-Z]+', 0), 'C', 'O') else term end as term, case when index % 3 = 0 then replace(regexp_extract(upper(body), '^[A-Z]+', 0), 'C', 'O') || ' ' || body else body end as body, case when index % 3 = 0 then 'legacy_unresolved' else entry_type end as entry_type from lex),
w as (select word, count(*) as n from (select unnest(regexp_extract_all(upper(body), '[A-Z]+')) as word from e) group by word),
o as (select * from e where entry_type in ('legacy_unresolved', 'legacy_retained') and regexp_matches(term, '^[A-Z]+$') and starts_with(upper(body), upper(term))),
one as (select index, term, body, substr(term, 1, i::int - 1) || 'C' || substr(term, i::int + 1) as corrected from o, range(1, 200) t(i) where i <= length(term) and substr(term, i::int, 1) = 'O'),
two as (select index, term, body, substr(corrected, 1, i::int - 1) || 'C' || substr(corrected, i::int + 1) as corrected from one, range(1, 200) t(i) where i <= length(corrected) and substr(corrected, i::int, 1) = 'O'),
made as (select distinct * from (select * from one union all select * from two) where length(corrected) >= 4 and corrected not in (select term from e)),
good as (select m.index, m.term, m.corrected, w.n, coalesce(v.n, 0) as own, list_contains(regexp_extract_all(upper(m.body), '[A-Z]+'), m.corrected) as in_body from made m join w on w.word = m.corrected left join w v on v.word = m.term)
select index, term, corrected, n, own, in_body from good where n > own or (length(corrected) >= 6 and (in_body or own <= 1)) qualify row_number() over (partition by index, term order by n desc, corrected) = 1""")
def frequency_corrections(spark, sf):
    """Unresolved headwords with O for C, that bodies have with C."""
    lex, third = lexicon(spark, sf), F.col("index") % 3 == 0
    spoiled = F.replace(F.regexp_extract(F.upper("body"), "^[A-Z]+", 0), F.lit("C"), F.lit("O"))
    e = lex.select("index", F.when(third, spoiled).otherwise(F.col("term")).alias("term"), F.when(third, F.concat(spoiled, F.lit(" "), "body")).otherwise(F.col("body")).alias("body"), F.when(third, "legacy_unresolved").otherwise(F.col("entry_type")).alias("entry_type"))
    return O.frequency_corrections(e)


@query("""with w as (select p_partkey as k, upper(p_name) as closest, case p_partkey % 5 when 0 then upper(p_name) || 'S' when 1 then substr(upper(p_name), 2) when 2 then 'X' || substr(upper(p_name), 2) when 3 then 'XY' || substr(upper(p_name), 4) else 'QQQ' end as term from part), d as (select *, levenshtein(term, closest) as d, p.k % 2 = 0 as inside from w p)
select k, case when inside and d <= 3 and k % 5 = 0 then 'tier2' when inside and d <= 2 then 'tier1' when inside and d <= 3 then 'tier2' when d = 1 then 'tier3' else 'none' end as tier from d""")
def duplicate_tiers(spark, sf):
    k, n = F.col("p_partkey"), F.upper("p_name")
    made = F.when(k % 5 == 0, F.concat(n, F.lit("S"))).when(k % 5 == 1, F.expr("substring(upper(p_name), 2)")).when(k % 5 == 2, F.expr("'X' || substring(upper(p_name), 2)")).when(k % 5 == 3, F.expr("'XY' || substring(upper(p_name), 4)")).otherwise("QQQ")
    w = table(spark, sf, "part").select(k.alias("k"), made.alias("term"), n.alias("closest"), F.levenshtein(made, n).alias("distance"), F.when(k % 2 == 0, n).otherwise("-").alias("body"))
    return O.duplicate_tiers(w).select("k", "tier")


# Layout and segmentation: lineitem stands for boxes on a page, documents for pages ------------------
BOX = """b as (select l_orderkey as page, l_linenumber as n, case when l_linenumber = 7 then '12' else 'word' end as text, cast(l_suppkey * 37 % 5100 as int) as x0, cast(l_partkey * 13 % 6601 as int) as y0, cast(l_partkey * 13 % 6601 + 40 as int) as y1 from lineitem)"""


def _boxes(spark, sf):
    b = table(spark, sf, "lineitem")
    y = F.col("l_partkey") * 13 % 6601
    return b.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("n"), F.when(F.col("l_linenumber") == 7, "12").otherwise("word").alias("text"), (F.col("l_suppkey") * 37 % 5100).cast("int").alias("x0"), y.cast("int").alias("y0"), (y + 40).cast("int").alias("y1"), F.lit(5100).alias("width"), F.lit(6601).alias("height"))


PLACED = f"with {BOX}, p as (select *, case when x0 < 2550 then 0 else 1 end as side from b where not (((y0 + y1) / 2.0 <= 0.09::double * 6601 or (y0 + y1) / 2.0 >= 0.94::double * 6601) and text = '12')), q as (select *, cast(row_number() over (partition by page order by side, y0, x0, text) as int) as position from p)"


@query(PLACED + " select page, side, position, x0, y0, text from q")
def page_layout(spark, sf):
    return G.layout(_boxes(spark, sf)).select("page", "side", "position", "x0", "y0", "text")


@query(PLACED + """, g as (select *, greatest(y0 - lag(y1) over (partition by page, side order by position), 0) as gap, lag(y1) over (partition by page, side order by position) as last_y from q), h as (select *, case when last_y is null then null else gap end as real_gap from g),
m as (select page, side, coalesce(median(real_gap), 0) as mg, median(y1 - y0) as mh from h group by page, side), k as (select h.*, coalesce(cast(real_gap > greatest(1.8::double * mg, 0.8::double * mh, 10.0) as int), 0) as opens from h join m using (page, side))
select page, side, position, cast(sum(opens) over (partition by page, side order by position) as bigint) as paragraph from k""")
def para_gaps(spark, sf):
    b = _boxes(spark, sf)
    return G.paragraph_gaps(G.layout(b)).select("page", "side", "position", "paragraph")


LINES = LEX + """, l as (select index, i, case when (index + i) % 4 = 0 then concat(upper(split_part(line, ' ', 1)), '. ', line) else line end as line from (select index, unnest(string_split(body, chr(10))) as line, generate_subscripts(string_split(body, chr(10)), 1) as i from lex where regexp_matches(term, '^[A-Z]')))"""


def _lines(spark, sf):
    # Outer, though no entry with a term is without lines: the plain form has each body folded and split once more.
    l = lexicon(spark, sf).where(F.col("term").rlike("^[A-Z]")).select("index", F.posexplode_outer(F.split("body", "\n")).alias("i", "line")).withColumn("i", F.col("i") + 1)
    return l.withColumn("line", F.when((F.col("index") + F.col("i")) % 4 == 0, F.concat(F.upper(F.split_part("line", F.lit(" "), F.lit(1))), F.lit(". "), "line")).otherwise(F.col("line")))


@query(LINES + r""" select index, i, regexp_replace(regexp_replace(regexp_extract(line, '^\s*((?:[A-Z0-9&''-]+,?\s+)*(?:(?:[A-Z]\.)*[A-Z]|[A-Z0-9&''-]+))(?:[.:;](?:\s|$)|,\s+(?:v\.|n\.|adj\.|adv\.|vb\.|prep\.|part\.|pl\.|pp\.)(?:\s|$))', 1), '\s+', ' ', 'g'), '[.,;:]+$', '') as head from l where not regexp_matches(line, '^\s*[—''"a-z-]') and
regexp_matches(line, '^\s*((?:[A-Z0-9&''-]+,?\s+)*(?:(?:[A-Z]\.)*[A-Z]|[A-Z0-9&''-]+))(?:[.:;](?:\s|$)|,\s+(?:v\.|n\.|adj\.|adv\.|vb\.|prep\.|part\.|pl\.|pp\.)(?:\s|$))')""")
def extract_headword(spark, sf):
    return _lines(spark, sf).select("index", F.col("i").cast("long"), G.headword(F.col("line")).alias("head")).where("head is not null")


@query()
def segment_entries(spark, sf):
    """Entries of a hundred volumes by the ordered state machine, the lexicon's own first words being known (tested against plain Python)."""
    l = _lines(spark, sf).withColumn("volume", F.col("index") % 100)
    l = l.withColumn("line", F.when((F.col("index") + F.col("i")) % 5 == 0, "").otherwise(F.col("line")))
    heads = lexicon(spark, sf).where("index % 2 = 0").select(F.split_part("term", F.lit(" "), F.lit(1)).alias("term"))
    return G.segment(l, "volume", "index", "i", heads, "line").groupBy("volume").agg(F.count("*").alias("entries"), F.sum(F.size("pages")).alias("pages"), F.sum(F.length("body")).alias("chars"))


@query()
def headword_duplicates(spark, sf):
    """Unresolved headwords that are verified ones misread, by head and body (difflib; tested by brute force)."""
    lex = lexicon(spark, sf).where("length(term) >= 4")
    verified = lex.where("index % 2 = 0").groupBy("term").agg(F.min_by("body", "index").alias("body"))
    i = F.col("index") % 3
    garbled = F.when(i == 0, F.replace("term", F.lit("C"), F.lit("O"))).when(i == 1, F.concat("term", F.lit("E"))).otherwise(F.col("term"))
    return O.headword_duplicates(lex.where("index % 10 = 0").select("index", garbled.alias("term"), "body"), verified)


@query(LEX + r""", b as (select index, term, concat(body, chr(10), chr(10), 'BAIL BOND, A bond', chr(10), chr(10), 'more text', chr(10), chr(10), 'XIV. The king', chr(10), chr(10), 'CASE. The thing') as body from lex),
p as (select index, term, unnest(string_split_regex(body, '\n\n+')) as part, generate_subscripts(string_split_regex(body, '\n\n+'), 1) - 1 as p from b),
h as (select *, regexp_extract(part, '^([A-Z][A-Z''&-]+(?: [A-Z][A-Z''&-]+){0,4})[.,] +[A-Z]', 1) as hd from p), m as (select *, p > 0 and hd <> '' and length(hd) >= 3 and not regexp_matches(hd, '^[IVXLCDM]+$') and hd <> term as good from h),
n as (select *, sum(cast(good as int)) over (partition by index order by p) as nth from m)
select index, cast(nth as bigint) as nth, max(case when good then hd end) as head, string_agg(part, chr(10) || chr(10) order by p) as text from n group by index, nth""")
def embedded_entries(spark, sf):
    tail = "\n\nBAIL BOND, A bond\n\nmore text\n\nXIV. The king\n\nCASE. The thing"
    b = lexicon(spark, sf).select("index", "term", F.concat("body", F.lit(tail)).alias("body"))
    return G.embedded(b)


EMBEDDED = ORACLES["embedded_entries"]


@query(f"with e as ({EMBEDDED}) select * from e where index in (select index from e group by index having max(nth) >= 2)")
def merged_entries(spark, sf):
    tail = "\n\nBAIL BOND, A bond\n\nmore text\n\nXIV. The king\n\nCASE. The thing"
    return G.split_merged(lexicon(spark, sf).select("index", "term", F.concat("body", F.lit(tail)).alias("body")))


@query(LEX + r""", pages as (select index as page, ['', concat(cast(index as varchar), '  ', upper(split_part(term, ' ', 1)), '   ', upper(split_part(term, ' ', 2)), '  '), body] as lines from lex where regexp_matches(term, '^[A-Z]{3,} [A-Z]{2,}$'))
select page, split_part(term, ' ', 1) as first_term, split_part(term, ' ', 2) as last_term from (select p.page, l.term from pages p join lex l on l.index = p.page)""")
def running_headers(spark, sf):
    t, one, two = F.col("term"), F.split_part("term", F.lit(" "), F.lit(1)), F.split_part("term", F.lit(" "), F.lit(2))
    p = lexicon(spark, sf).where(t.rlike("^[A-Z]{3,} [A-Z]{2,}$")).select(F.col("index").alias("page"), F.array(F.lit(""), F.concat(F.col("index").cast("string"), F.lit("  "), one, F.lit("   "), two, F.lit("  ")), F.col("body")).alias("lines"))
    return G.running_headers(p).select("page", "first_term", "last_term")


@query()
def align_terms(spark, sf):
    """Alignment of all terms with spoiled ones, by letter (tested against a plain recursion)."""
    lex = lexicon(spark, sf).select("index", "term", "body")
    spoiled = lex.where("index % 7 <> 3").withColumn("term", F.when(F.col("index") % 5 == 0, F.concat("term", F.lit("S"))).otherwise(F.col("term")))
    matches = G.align(lex.select("index", "term"), spoiled.select("index", "term"))
    return G.assemble(lex, spoiled, matches).select("index", "term", "source_headword", "score")


@query(LEX + "select distinct upper(regexp_replace(term, '[.,;:]+$', '')) as word from lex where length(regexp_replace(term, '[.,;:]+$', '')) > 2")
def wordlist(spark, sf):
    return io.wordlist(lexicon(spark, sf))


FLAGGED = """f as (select index, term, (index % 20) / 20.0::double as confidence, case when index % 3 = 0 then ['headword_mismatch'] when index % 3 = 1 then ['short_body'] else [] end as flags, case when index % 4 = 0 then null when index % 4 = 1 then term else concat(term, 'S') end as suggested_term, case when index % 5 = 0 then null else term end as source_headword from lex)"""


def _flagged(spark, sf):
    i = F.col("index")
    flags = F.when(i % 3 == 0, F.array(F.lit("headword_mismatch"))).when(i % 3 == 1, F.array(F.lit("short_body"))).otherwise(F.array().cast("array<string>"))
    suggested = F.when(i % 4 == 0, None).when(i % 4 == 1, F.col("term")).otherwise(F.concat("term", F.lit("S")))
    return lexicon(spark, sf).select("index", "term", (i % 20 / 20.0).alias("confidence"), flags.alias("flags"), suggested.alias("suggested_term"), F.when(i % 5 != 0, F.col("term")).alias("source_headword"))


@query(LEX + f", {FLAGGED} select index, case when confidence >= 0.95 and list_contains(flags, 'headword_mismatch') and suggested_term is not null then suggested_term else term end as fixed_term from f")
def safe_term_fix(spark, sf):
    return O.safe_term_fix(_flagged(spark, sf)).select("index", "fixed_term")


@query(LEX + f""", {FLAGGED}, r as (select index, confidence < 0.9 or len(flags) > 0 as low, confidence >= 0.9 and coalesce(suggested_term <> term, false) as fix from f)
select index, concat_ws(',', case when low then 'low_confidence' end, case when fix then 'term_fix' end) as report from r where low or fix""")
def review_reports(spark, sf):
    return O.reports(_flagged(spark, sf)).select("index", F.array_join("report", ",").alias("report"))


@query(LEX + f", {FLAGGED} select count(*) as rows, count(source_headword) as sourced, count(*) filter (len(flags) > 0) as flagged, printf('%.1f%%', 100.0 * count(source_headword) / greatest(count(*), 1)) as share from f")
def phase_stats(spark, sf):
    return O.phase_stats(_flagged(spark, sf))


@query(LEX + """, m as (select distinct case when index % 2 = 0 then replace(term, 'R', 'B') else concat(term, 'S') end as term from lex where regexp_matches(term, '^[A-Z ]{5,20}$') and index % 3 = 0), heads as (select distinct term from lex), fx as (select m.term, min(h.term) as t from m join heads h on h.term = left(m.term, length(m.term) - 1) where right(m.term, 1) = 'S' group by m.term),
n as (select m.term, arg_min(h.term, (levenshtein(m.term, h.term), h.term)) as n from m, heads h where abs(length(m.term) - length(h.term)) <= 2 and levenshtein(m.term, h.term) <= 2 group by m.term),
one as (select term, substr(term, 1, i::int - 1) || 'R' || substr(term, i::int + 1) as c from m, range(1, 40) t(i) where i <= length(term) and substr(term, i::int, 1) = 'B'), two as (select term, substr(c, 1, i::int - 1) || 'R' || substr(c, i::int + 1) as c from one, range(1, 40) t(i) where i <= length(c) and substr(c, i::int, 1) = 'B'),
b as (select term, min(c) as b from (select * from one union all select * from two) where c in (select term from heads) group by term)
select m.term, coalesce(fx.t, b.b, n.n) as fixed from m left join fx on fx.term = m.term left join b on b.term = m.term left join n on n.term = m.term""")
def xref_correction(spark, sf):
    from ..operators import xref as X

    lex, i = lexicon(spark, sf), F.col("index")
    made = F.when(i % 2 == 0, F.replace("term", F.lit("R"), F.lit("B"))).otherwise(F.concat("term", F.lit("S")))
    m = lex.where(F.col("term").rlike("^[A-Z ]{5,20}$") & (i % 3 == 0)).select(made.alias("term")).distinct()
    fixes = m.where("right(term, 1) = 'S'").select("term", F.expr("left(term, length(term) - 1)").alias("fixed"))
    return X.correct(m, lex, fixes)


@query(LEX + """, b as (select distinct split_part(term, ' ', 1) as w, index from lex where regexp_matches(term, '^[A-Z]{4,12} ')), m as (select distinct case index % 4 when 0 then w when 1 then concat(w, 'Q') when 2 then concat(w, ' SUBENTRY OF IT') else concat('QQ', index, 'XX') end as term from b where index % 2 = 0 or index % 4 = 3 or index % 4 = 1),
ov as (select distinct w as term from b where index % 3 = 0), lv as (select distinct w as term from b where index % 3 = 1), cd as (select distinct w as term from b where index % 3 = 2),
x as (select m.term, exists (select 1 from ov where ov.term = m.term or levenshtein(ov.term, m.term) <= 2) or exists (select 1 from lv where lv.term = m.term) as found, exists (select 1 from cd where levenshtein(cd.term, m.term) <= 2) as rec, exists (select 1 from lv where lv.term = regexp_extract(m.term, '^([^ ,]+)[ ,]', 1) and length(lv.term) >= 4) as sub from m)
select term, case when found then 'FOUND' when rec then 'RECOVERABLE' when sub then 'SUBENTRY' when regexp_matches(term, '^[^A-Z]*$|^.{1,2}$|[^A-Z0-9 ,.''&-]{2,}') then 'DEBRIS' else 'NOT_FOUND' end as gap from x""")
def gap_classify(spark, sf):
    i = F.col("index")
    b = settled(lexicon(spark, sf).where(F.col("term").rlike("^[A-Z]{4,12} ")).select(F.split_part("term", F.lit(" "), F.lit(1)).alias("w"), "index"))
    made = F.when(i % 4 == 0, F.col("w")).when(i % 4 == 1, F.concat("w", F.lit("Q"))).when(i % 4 == 2, F.concat("w", F.lit(" SUBENTRY OF IT"))).otherwise(F.concat(F.lit("QQ"), i.cast("string"), F.lit("XX")))
    part = lambda k: b.where(i % 3 == k).select(F.col("w").alias("term"))
    return O.classify_gaps(b.select(made.alias("term")).distinct(), part(0), part(1), part(2)).select("term", "gap")


@query()
def boundary_decisions(spark, sf):
    """Decisions on entries hidden in bodies (tested by hand-made cases)."""
    lex = lexicon(spark, sf)
    e = lex.select("index", "term", F.concat("body", F.lit("\n\n"), F.upper(F.regexp_extract("body", "[A-Za-z]{4,}", 0)), F.lit(". A thing that is long enough to stand")).alias("body"))
    return O.boundary_decisions(e, lex.where("index % 2 = 0")).groupBy("action").agg(F.count("*").alias("n"))


@query()
def header_gaps(spark, sf):
    """Kinds of running-header terms (parts have SQL twins; tested by hand-made cases)."""
    lex = lexicon(spark, sf)
    h = lex.select(F.split_part("term", F.lit(" "), F.lit(1)).alias("first_term"), F.concat("term", F.lit("X")).alias("last_term"))
    return O.header_gaps(h, lex.where("index % 2 = 0").select("term"), lex.where("index % 2 = 1").select("term"), lex.select("index", "body")).groupBy("kind").agg(F.count("*").alias("n"))


@query()
def validate_terms(spark, sf):
    """Missing reference terms with close headwords (difflib; tested by hand-made cases)."""
    part = table(spark, sf, "part").select(F.upper("p_name").alias("term")).distinct()
    return O.validate_terms(part.select(F.concat("term", F.lit("X")).alias("term")), part).select("term", F.array_join("close", "|").alias("close"))
