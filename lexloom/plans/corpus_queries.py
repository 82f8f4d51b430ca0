"""Queries of counts, sets, pages and cross-references."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import pages as P
from ..operators import xref as X
from .lexicon import SQL, lexicon, table
from .registry import query

LEX = f"with {SQL}"


@query(LEX + "select entry_type, count(*) as n, min(index) as first from lex group by entry_type")
def type_counts(spark, sf):
    return A.counts(lexicon(spark, sf), "entry_type", "index")


@query(LEX + "select index, term, previous from (select index, term, lag(index) over (partition by term order by index) as previous from lex) where previous is not null")
def duplicate_terms(spark, sf):
    return A.duplicates(lexicon(spark, sf), "term", "index").select("index", "term", "previous")


@query(LEX + "select word, count(*) as n from (select unnest(regexp_extract_all(upper(body), '[A-Z]+')) as word from lex) group by word")
def word_frequency(spark, sf):
    return A.word_frequency(lexicon(spark, sf), "body")


@query(LEX + "select cast(sum(len(list_filter(regexp_extract_all(upper(body), '[A-Z]+'), lambda w: w = 'THAT'))) as bigint) as n from lex")
def phrase_count(spark, sf):
    return A.phrase_count(lexicon(spark, sf), "body", "THAT")


@query(LEX + """, a as (select distinct term from lex where index % 3 <> 0 and length(term) >= 2), b as (select distinct term from lex where index % 3 <> 1 and length(term) >= 2), n as (select (select count(*) from a) as in_a, (select count(*) from b) as in_b, (select count(*) from a join b using (term)) as shared)
select in_a, in_b, shared, in_a - shared as only_a, in_b - shared as only_b, printf('%.1f%%', 100.0 * shared / greatest(in_a, 1)) as share_of_a from n""")
def set_compare(spark, sf):
    lex = lexicon(spark, sf)
    return A.set_compare(lex.where("index % 3 <> 0"), lex.where("index % 3 <> 1"), "term")


@query(LEX + "select index, term from lex where index % 3 = 0 and term not in (select term from lex where index % 3 <> 0)")
def set_without(spark, sf):
    lex = lexicon(spark, sf)
    return A.without(lex.where("index % 3 = 0"), lex.where("index % 3 <> 0"), "term").select("index", "term")


@query(LEX + """, old as (select index, term, printf('BLD2-%05d', index) as id from lex where index % 3 <> 0), fresh as (select index, term, row_number() over (order by index) as n from lex where index % 3 = 0 and term not in (select term from old))
select index, term, id from old union all select index, term, printf('BLD2-%05d', n + (select max(index) from old)) from fresh""")
def append_new(spark, sf):
    lex = lexicon(spark, sf).select("index", "term", N.stable_id("index").alias("id"))
    return A.append_new(lex.where("index % 3 <> 0"), lex.where("index % 3 = 0").drop("id"), "term", "index")


@query(LEX + "select letter, concat('entries_', lower(letter), '.json') as file, count(*) as count from (select case when term = '' then 'A' else upper(substr(term, 1, 1)) end as letter from lex) where letter between 'A' and 'Z' and length(letter) = 1 group by letter")
def manifest(spark, sf):
    from ..sources.io import manifest as of

    return of(lexicon(spark, sf))


@query("select case when grouping(c_mktsegment) = 1 then 'ALL' else c_mktsegment end as segment, count(*) as n, cast(sum(case when c_acctbal < 0 then 1 else 0 end) as bigint) as negative from customer group by rollup (c_mktsegment)")
def letter_rollup(spark, sf):
    c = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "segment")
    return A.letter_rollup(c, "segment", n=F.count("*"), negative=F.sum((F.col("c_acctbal") < 0).cast("int")))


@query(LEX + "select term, list_sort(list(index)) as ids from lex group by term")
def term_ids(spark, sf):
    return A.ids_of(lexicon(spark, sf), "term", "index")


@query(LEX + "select entry_type, index, rank, class_size from (select entry_type, index, cast(row_number() over (partition by entry_type order by index) as int) as rank, count(*) over (partition by entry_type) as class_size from lex) where rank <= 5")
def examples_topk(spark, sf):
    return A.examples(lexicon(spark, sf), "entry_type", "index", 5).select("entry_type", "index", "rank", "class_size")


@query(LEX + "select index, length(body) as n, row_number() over (order by length(body) desc, index) as rank from lex")
def length_ranks(spark, sf):
    return A.ranks(lexicon(spark, sf).select("index", F.length("body").cast("long").alias("n")), "n", "index").select("index", "n", "rank")


@query(LEX + "select term, min(index) as index from lex group by term")
def first_per_parent(spark, sf):
    return J.first_wins(lexicon(spark, sf).select("term", "index", "body"), "term", "index").select("term", "index")


@query(LEX + "select term, max(index) as index from lex group by term")
def last_per_key(spark, sf):
    return J.first_wins(lexicon(spark, sf).select("term", "index", "body"), "term", "index", last=True).select("term", "index")


@query(LEX + "select term, index, body from (select *, row_number() over (partition by term order by length(body) desc, index) as r from lex) where r = 1")
def longest_per_key(spark, sf):
    return A.longest(lexicon(spark, sf), "term", "body", "index")


@query(LEX + "select entry_type, count(*) as now, count(*) filter (index % 4 <> 0) as before, count(*) filter (index % 4 = 0) as delta from lex group by entry_type")
def build_delta(spark, sf):
    lex = lexicon(spark, sf)
    return A.build_delta(lex, lex.where("index % 4 <> 0"), "entry_type")


# Pages: the orders of a segment stand for the entries of a letter -------------------------------------
PAGES = """paged as (select o_orderkey as k, substr(o_orderpriority, 1, 1) as letter, 1 + (o_orderkey * 7919) % 1238 as page, upper(o_orderpriority) || o_custkey as head from orders)"""
SORTED = f"with {PAGES}, s as (select letter, list_sort(list(page)) as p, count(*) as n from paged group by letter)"


def _paged(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("k"), F.substring("o_orderpriority", 1, 1).alias("letter"), (1 + F.col("o_orderkey") * 7919 % 1238).alias("page"), F.concat(F.upper("o_orderpriority"), F.col("o_custkey").cast("string")).alias("head"))


RANGES = "select letter, n, p[1] as min, case when n < 3 then p[1] else p[1 + cast(floor(n * 0.1::double) as bigint)] end as p10, p[1 + n // 2] as median, case when n < 3 then p[n] else p[1 + least(cast(floor(n * 0.9::double) as bigint), n - 1)] end as p90, p[n] as max from s"
FENCES = "select letter, n, case when n < 4 then p[1] else p[1 + n // 4] - greatest(2 * (p[1 + 3 * n // 4] - p[1 + n // 4]), 30) end as lower, case when n < 4 then p[n] else p[1 + 3 * n // 4] + greatest(2 * (p[1 + 3 * n // 4] - p[1 + n // 4]), 30) end as upper from s"


@query(f"{SORTED} {RANGES}")
def letter_ranges(spark, sf):
    return P.letter_ranges(_paged(spark, sf))


@query(f"""with {PAGES}, spread as (select k, letter, case when k % 97 = 0 then page * 5 else page % 300 end as page from paged), s as (select letter, list_sort(list(page)) as p, count(*) as n from spread group by letter), f as ({FENCES}), r as ({RANGES})
select k, sp.letter, sp.page, case when abs(sp.page - median) > 200 then 'high' else 'medium' end as severity from spread sp join f on f.letter = sp.letter join r on r.letter = sp.letter where sp.page < lower or sp.page > upper""")
def iqr_outliers(spark, sf):
    p = _paged(spark, sf).withColumn("page", F.when(F.col("k") % 97 == 0, F.col("page") * 5).otherwise(F.col("page") % 300))
    return P.outliers(p, "letter", "page").select("k", "letter", "page", "severity")


BROKEN = f"""with {PAGES}, m as (select *, max(page) over w as running_max, row_number() over (partition by letter order by head, k) as pos from paged window w as (partition by letter order by head, k rows between unbounded preceding and 1 preceding)),
raised as (select letter, pos, page, head from m where page > coalesce(running_max, 0)),
broken as (select m.k, m.letter, m.page, m.running_max, m.running_max - m.page as jump, (select arg_max(r.head, r.pos) from raised r where r.letter = m.letter and r.pos < m.pos) as previous from m where m.page < m.running_max - 12)"""


@query(BROKEN + "select k, letter, page, running_max, jump, previous from broken")
def monotonic_breaks(spark, sf):
    return P.breaks(_paged(spark, sf), "letter", "head", "page", "k").select("k", "letter", "page", "running_max", "jump", "previous")


@query(BROKEN + "select case when jump <= 5 then '1-5' when jump <= 10 then '6-10' when jump <= 20 then '11-20' when jump <= 50 then '21-50' when jump <= 100 then '51-100' else '100+' end as bucket, count(*) as n from broken group by 1")
def jump_histogram(spark, sf):
    return P.histogram(P.breaks(_paged(spark, sf), "letter", "head", "page", "k")).select("bucket", "n")


@query(f"""with {PAGES}, known as (select k, letter, head, case when k % 3 = 0 then page end as page from paged)
select k, last_value(page ignore nulls) over (partition by letter order by head, k rows between unbounded preceding and 1 preceding) as before, first_value(page ignore nulls) over (partition by letter order by head, k rows between 1 following and unbounded following) as after from known""")
def neighbor_asof(spark, sf):
    p = _paged(spark, sf).withColumn("page", F.when(F.col("k") % 3 == 0, F.col("page")))
    return J.neighbours(p, ["head", "k"], "page", "letter").select("k", "before", "after")


@query(f"with {PAGES} select a.k, b.p_partkey as part, b.p_partkey - a.page as gap from paged a join part b on abs(a.page - b.p_partkey) <= 2")
def page_band_join(spark, sf):
    a = _paged(spark, sf)
    b = table(spark, sf, "part").select(F.col("p_partkey").alias("part"))
    return J.band(a, b, "page", "part", 2).select("k", "part", (F.col("part") - F.col("page")).alias("gap"))


@query(f"with {PAGES} select k, part, gap from (select a.k, b.p_partkey as part, abs(b.p_partkey - a.page) as gap, row_number() over (partition by a.k order by abs(b.p_partkey - a.page), b.p_partkey) as r from paged a join part b on abs(a.page - b.p_partkey) <= 5 and b.p_size > 25) where r = 1")
def closest_candidate(spark, sf):
    a = _paged(spark, sf)
    b = table(spark, sf, "part").where("p_size > 25").select(F.col("p_partkey").alias("part"))
    pairs = J.band(a, b, "page", "part", 5).select("k", "part", F.abs(F.col("part") - F.col("page")).alias("gap"))
    return J.closest(pairs, "k", F.col("gap"), "part").select("k", "part", "gap")


@query(f"""with {PAGES}, odd as (select k, letter, page + ascii(letter) * 20 as page from paged), s as (select letter, list_sort(list(page)) as p, count(*) as n from odd group by letter), r as ({RANGES}), ask as (select k, k % 3000 as page from paged),
b as (select distinct a.page, r.letter, not (a.page between r.min and r.max) as outside, case when a.page between r.min and r.max then abs(a.page - r.median) else least(abs(a.page - r.min), abs(a.page - r.max)) end as gap from ask a, r)
select k, page, (select arg_min(letter, (outside, gap, letter)) from b where b.page = ask.page) as inferred from ask""")
def infer_letter(spark, sf):
    p = _paged(spark, sf)
    ranges = P.letter_ranges(p.withColumn("page", F.col("page") + F.ascii("letter") * 20))
    return P.infer_letter(p.select("k", (F.col("k") % 3000).alias("page")), ranges, "k", "page").select("k", "page", "inferred")


@query(LEX + """, lines as (select index as page, unnest(string_split(body, chr(10))) as line from lex), terms as (select distinct term from lex where regexp_matches(term, '^[A-Z]')),
m as (select t.term, l.page from terms t join lines l on starts_with(upper(ltrim(l.line, ' ')), t.term) and substr(upper(ltrim(l.line, ' ')), length(t.term) + 1, 1) in ('.', ',', ''))
select term, list_sort(list(distinct page)) as pages from m group by term having count(distinct page) <= 3""")
def line_start_pages(spark, sf):
    lex = lexicon(spark, sf)
    lines = lex.select(F.col("index").alias("page"), F.explode(F.split("body", "\n")).alias("line"))
    return J.line_start(lex.select("term").where(F.col("term").rlike("^[A-Z]")).distinct(), lines)


@query(LEX + """, t as (select distinct term from lex where regexp_matches(term, '^[A-Z]+ [A-Z]+$')), b as (select index, concat(' ', array_to_string(list_filter(string_split_regex(upper(body), '[^A-Z0-9]+'), lambda w: w <> ''), ' '), ' ') as flat from lex)
select term, index from t join b on contains(flat, concat(' ', term, ' '))""")
def term_in_body(spark, sf):
    lex = lexicon(spark, sf)
    return J.containing(lex.select("term").where(F.col("term").rlike("^[A-Z]+ [A-Z]+$")).distinct(), lex.select("index", "body")).select("term", "index")


@query(LEX + """, w as (select index, term as k1, upper(split_part(term, ' ', 1)) as k2 from lex where index % 2 = 0), h as (select term, min(index) as v from lex where index % 2 = 1 group by term)
select w.index, coalesce(a.v, b.v) as v from w left join h a on a.term = w.k1 left join h b on b.term = w.k2""")
def fallback_join(spark, sf):
    lex = lexicon(spark, sf)
    w = lex.where("index % 2 = 0").select("index", F.col("term").alias("k1"), F.upper(F.split_part("term", F.lit(" "), F.lit(1))).alias("k2"))
    h = lex.where("index % 2 = 1").groupBy("term").agg(F.min("index").alias("v"))
    return J.fallback(w, ["k1", "k2"], h, "term", "v").select("index", "v")


@query(LEX + """, a as (select term, min(index) as place from lex where index % 2 = 0 group by term), b as (select translate(term, '!1|0Z', 'IIIOE') as term, min(index) as place from lex where index % 2 = 1 group by 1), flat as (select index, concat(' ', array_to_string(list_filter(string_split_regex(upper(body), '[^A-Z0-9]+'), lambda w: w <> ''), ' '), ' ') as flat from lex),
runs as (select distinct term, concat(' ', array_to_string(list_filter(string_split_regex(upper(term), '[^A-Z0-9]+'), lambda w: w <> ''), ' '), ' ') as run from lex),
c as (select term, min(index) as place from runs join flat on run not in (' ', '  ') and contains(flat, run) group by term),
f as (select term, place, 0 as strategy from a union all select term, place, 1 from b union all select term, place, 2 from c)
select distinct l.term, m.place, m.strategy from lex l left join (select term, arg_min(place, (place, strategy)) as place, cast(arg_min(strategy, (place, strategy)) as int) as strategy from f group by term) m on m.term = l.term""")
def scan_in_order(spark, sf):
    lex = lexicon(spark, sf)
    a = lex.where("index % 2 = 0").groupBy("term").agg(F.min("index").alias("place"))
    b = lex.where("index % 2 = 1").groupBy(N.ocr_key("term").alias("term")).agg(F.min("index").alias("place"))
    c = J.first_containing(lex.select("term").distinct(), lex).withColumnRenamed("index", "place")
    return J.scan_in_order(lex.select("term").distinct(), [a, b, c])


# Cross-references: planted at the end of bodies, as the tables have none ----------------------------
REFS = LEX + r""", heads as (select distinct term from lex where regexp_matches(term, '^[A-Z]+( [A-Z]+)?$')),
xb as (select index, concat('See also ', term, ' EXTRA WORD; ', split_part(term, ' ', 1), '. Then ', lower(split_part(term, ' ', 2)), ' ', term, ' (q. v.) or the ', term, ', which see') as body from lex where regexp_matches(term, '^[A-Z]+ [A-Z]+$')),
stop as (select unnest([STOPWORDS]) as w),
fw as (select index, n - 1 as nth, unnest(string_split(raw, ';')) as raw, generate_subscripts(string_split(raw, ';'), 1) - 1 as part from (select index, unnest(regexp_extract_all(body, '\b(See also|See|see|Vide|Same as)\s+([A-Z][A-Z ''&.;,-]{0,80})', 2)) as raw, generate_subscripts(regexp_extract_all(body, '\b(See also|See|see|Vide|Same as)\s+([A-Z][A-Z ''&.;,-]{0,80})', 2), 1) as n from xb)),
forward as (select index, nth * 100 + part as nth, regexp_replace(regexp_replace(raw, '^\s+', ''), '[,;:.\s]+$', '') as raw from fw where regexp_replace(regexp_replace(raw, '^\s+', ''), '[,;:.\s]+$', '') <> ''),
qv as (select index, unnest(regexp_extract_all(body, '((?:[A-Za-z''-]+\s+){0,3}[A-Za-z''-]+)\s*\(q\. v\.\)', 1)) as raw from xb),
ws as (select index, unnest(regexp_extract_all(body, '((?:[A-Za-z''-]+\s+){0,4}[A-Za-z''-]+),\s*which see', 1)) as raw from xb),
pre as (select raw, n, upper(array_to_string(w[1:n], ' ')) as term, array_to_string(w[n + 1:len(w)], ' ') as rest from (select distinct raw, string_split_regex(raw, '\s+') as w from forward), range(1, 30) t(n) where n <= len(w)),
best_pre as (select raw, max(n) as n, arg_max(term, n) as target, arg_max(rest, n) as rest from pre where length(term) >= 2 and term not in (select w from stop) and term in (select term from heads) group by raw),
sub as (select raw, n, pos, upper(array_to_string(w[pos:pos + n - 1], ' ')) as term from (select distinct raw, string_split_regex(raw, '\s+') as w from (select raw from qv union select raw from ws)), range(1, 10) t(n), range(1, 10) u(pos) where pos + n - 1 <= len(w)),
best_sub as (select raw, arg_max(term, (n, pos)) as target from sub where length(term) >= 2 and term not in (select w from stop) and term in (select term from heads) group by raw)
""".replace("STOPWORDS", ",".join(f"'{w}'" for w in X.STOP))


def _refs(spark, sf):
    lex = lexicon(spark, sf)
    heads = lex.where(F.col("term").rlike("^[A-Z]+( [A-Z]+)?$")).select("term").distinct()
    t, one, two = F.col("term"), F.split_part("term", F.lit(" "), F.lit(1)), F.lower(F.split_part("term", F.lit(" "), F.lit(2)))
    body = F.concat(F.lit("See also "), t, F.lit(" EXTRA WORD; "), one, F.lit(". Then "), two, F.lit(" "), t, F.lit(" (q. v.) or the "), t, F.lit(", which see"))
    return lex.where(t.rlike("^[A-Z]+ [A-Z]+$")).select("index", body.alias("body")), heads


@query(REFS + "select f.index, f.nth, f.raw, b.target, b.rest from forward f left join best_pre b on b.raw = f.raw")
def xref_forward(spark, sf):
    b, h = _refs(spark, sf)
    return X.resolve_forward(X.forward(b), h).select("index", F.col("nth").cast("long"), "raw", "target", "rest")


@query(REFS + "select q.index, q.raw, b.target from qv q left join best_sub b on b.raw = q.raw")
def xref_qv(spark, sf):
    b, h = _refs(spark, sf)
    return X.resolve_back(X.back(b), h).select("index", "raw", "target")


@query(REFS + "select q.index, q.raw, b.target from ws q left join best_sub b on b.raw = q.raw")
def xref_which_see(spark, sf):
    b, h = _refs(spark, sf)
    return X.resolve_back(X.which_see(b), h).select("index", "raw", "target")


@query(REFS + """, r as (select 'forward' as kind, b.target from forward f left join best_pre b on b.raw = f.raw union all select 'qv', b.target from qv q left join best_sub b on b.raw = q.raw union all select 'which_see', b.target from ws q left join best_sub b on b.raw = q.raw)
select kind, count(*) as total, count(target) as resolved, printf('%.1f%%', 100.0 * count(target) / greatest(count(*), 1)) as rate from r group by kind""")
def xref_rates(spark, sf):
    b, h = _refs(spark, sf)
    parts = [X.resolve_forward(X.forward(b), h), X.resolve_back(X.back(b), h), X.resolve_back(X.which_see(b), h)]
    return X.rates(parts[0].select("kind", "target").unionByName(parts[1].select("kind", "target")).unionByName(parts[2].select("kind", "target")))


SEES = LEX + r""", b as (select index, concat('See ', regexp_replace(term, '[AEIOU]', 'E'), ' or See ', term, '.') as body from lex), heads as (select distinct term from lex),
s as (select index, trim(unnest(regexp_extract_all(body, '\bSee ([A-Z][A-Z ]{2,})', 1))) as term from b), missing as (select term, count(*) as n, count(distinct index) as entries from s where term not in (select term from heads) group by term)
"""


def _sees(spark, sf):
    lex = lexicon(spark, sf)
    body = F.concat(F.lit("See "), F.expr("regexp_replace(term, '^([^AEIOU]*)[AEIOU]', '$1E')"), F.lit(" or See "), F.col("term"), F.lit("."))
    return X.unresolved(X.strict(lex.select("index", body.alias("body"))), lex), lex


@query(SEES + "select term, n, entries from missing")
def xref_unresolved(spark, sf):
    return _sees(spark, sf)[0]


@query(SEES + "select term, n from missing order by n desc, term limit 20")
def missing_top(spark, sf):
    from ..operators.search import top_by

    return top_by(_sees(spark, sf)[0], F.col("n"), 20, "term").select("term", "n")


@query(SEES + """, compact as (select regexp_replace(term, '[\\s-]', '', 'g') as ck, min(term) as compact from heads group by 1), hidden as (select distinct term from lex where entry_type = 'fragment_artifact'),
near as (select m.term, arg_min(h.term, (levenshtein(m.term, h.term), h.term)) as near, min(levenshtein(m.term, h.term)) as d from missing m, heads h where length(m.term) >= 8 and abs(length(m.term) - length(h.term)) <= 2 and levenshtein(m.term, h.term) <= 2 group by m.term),
inside as (select distinct m.term from missing m join lex l on length(m.term) > 0 and contains(upper(l.body), m.term) and upper(l.term) <> m.term),
j as (select m.term, c.compact, i.term is not null as inside, h.term is not null as hid, case when length(m.term) >= 12 or d <= 1 then near end as near from missing m left join compact c on c.ck = regexp_replace(m.term, '[\\s-]', '', 'g') left join hidden h on h.term = m.term left join near on near.term = m.term left join inside i on i.term = m.term)
select term, case when regexp_matches(term, '[0-9]') then 'ocr_garbled' when length(term) <= 3 or (length(regexp_extract(term, '(\\S+)$', 1)) = 1 and regexp_extract(term, '(\\S+)$', 1) <> 'A') then 'truncated' when hid then 'suppressed' when compact is not null then 'compact_match' when inside then 'subentry' when near is not null then 'fuzzy' else 'absent' end as reason, case when compact is not null or not inside then coalesce(compact, near) end as suggestion from j""")
def xref_triage(spark, sf):
    missing, lex = _sees(spark, sf)
    return X.triage(missing.select("term"), lex.select("term").distinct(), lex.where("entry_type = 'fragment_artifact'"), entries=lex)


@query(LEX + r"""select index, upper(regexp_extract(concat('See ', term, '.'), '^\s*[Ss]ee\s+([A-Z][A-Za-z ''&-]{1,80}?)\s*[.,;]?\s*$', 1)) as target from lex where regexp_matches(concat('See ', term, '.'), '^\s*[Ss]ee\s+([A-Z][A-Za-z ''&-]{1,80}?)\s*[.,;]?\s*$')""")
def see_targets(spark, sf):
    return lexicon(spark, sf).select("index", X.see_target(F.concat(F.lit("See "), "term", F.lit("."))).alias("target")).where("target is not null")


@query(LEX + "select index, row_number() over (order by term, index) - 1 as source_index, page from lex where page between 12 and 1249")
def leaf_candidates(spark, sf):
    """Candidates on leaves of the dictionary, numbered in order of term by a prefix scan."""
    from ..operators import segment as G

    lex = lexicon(spark, sf).select("index", "page", F.array("page").alias("leaves"), F.struct("term", "index").alias("source_index"))
    return G.in_leaves(lex).select("index", F.col("source_index").cast("long").alias("source_index"), "page")
