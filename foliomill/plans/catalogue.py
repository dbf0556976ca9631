"""Every query of the core library, with its SQL where SQL can express it.

Names begin with the survey's operator number. A query is (spark, data directory) -> DataFrame
over whole tables; its SQL runs on the same tables in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import anchors, audit, checks, chunking, cleaning, grids, identity, lookup, pages, patches, records, search, sequences, toc, words
from ..runtime import table
from . import relational, views

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: The chunk, page and Markdown views of plans.views, in SQL.
_CHUNKS = r"""c0 AS (SELECT DISTINCT id, package_id, content, page, section, token_count FROM chunks),
c1 AS (SELECT *, CAST(regexp_extract(id, '_(\d+)$', 1) AS INT) seq,
  TRY_CAST(nullif(regexp_extract(page, '(\d+)', 1), '') AS INT) pa, TRY_CAST(nullif(regexp_extract(page, '\d+\s*[-–—]\s*(\d+)', 1), '') AS INT) pb FROM c0),
c AS (SELECT *, least(pa, coalesce(pb, pa)) page_first, greatest(pa, coalesce(pb, pa)) page_last FROM c1)"""
_MD = (
    _CHUNKS
    + r""", md AS (SELECT package_id, seq, (CASE WHEN page_first IS NOT NULL THEN '<!-- pages ' || page_first || '-' || page_last || ' -->' || chr(10) ELSE '' END)
  || (CASE WHEN coalesce(section, '') <> '' THEN '## ' || regexp_replace(section, '[\r\n]+', ' ', 'g') || chr(10) ELSE '' END) || coalesce(content, '') AS text FROM c),
l0 AS (SELECT package_id, seq, string_split(text, chr(10)) ls FROM md),
l AS (SELECT package_id, seq * 1048576 + i AS place, line, TRY_CAST(nullif(regexp_extract(line, '<!--\s*pages?\s*(\d+)\s*[-–—]\s*(\d+)\s*-->', 1), '') AS INT) a,
  TRY_CAST(nullif(regexp_extract(line, '<!--\s*pages?\s*(\d+)\s*[-–—]\s*(\d+)\s*-->', 2), '') AS INT) z, nullif(length(regexp_extract(line, '^(#{1,6})\s+(.+)$', 1)), 0) lev,
  regexp_replace(regexp_extract(line, '^(#{1,6})\s+(.+)$', 2), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') title
  FROM (SELECT package_id, seq, unnest(ls) line, unnest(range(0, len(ls))) i FROM l0))"""
)
_TOKENS = "regexp_extract_all(lower({0}), '([a-z0-9]+|[一-鿿])', 1)"
_TOC = "e AS (SELECT package_id, ord, x.title, x.page, x.depth FROM (SELECT package_id, ord, min({'title': coalesce(title, ''), 'page': target_page, 'depth': depth}) x FROM toc_tree GROUP BY ALL))"
_SEEN = "s AS (SELECT package_id, page, array_to_string(list_filter(v.k, lambda x: x IS NOT NULL), ' ') AS text, list_transform(v.e, lambda x: x.type) types FROM (SELECT package_id, page, max_by({'k': key_text, 'e': visual_elements}, vlm_id) v FROM vlm_eval WHERE parse_status = 'ok' GROUP BY ALL))"
_PAGES = _CHUNKS + ", p AS (SELECT package_id, page_first AS page, string_agg(content, chr(10) ORDER BY seq, content) AS text FROM c WHERE page_first IS NOT NULL AND content IS NOT NULL GROUP BY ALL)"
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_COLON_SIDE = r"regexp_extract(s, '^(.{2,40})[：:]\s*(.{1,200})$', %d)"
_COLON = (
    _MD
    + rf""", k0 AS (SELECT package_id, place, {_STRIP.format('line')} s FROM l),
k1 AS (SELECT package_id, place, s, {_STRIP.format(_COLON_SIDE % 1)} key, {_STRIP.format(_COLON_SIDE % 2)} v
  FROM k0 WHERE regexp_matches(s, '^(.{{2,40}})[：:]\s*(.{{1,200}})$'))"""
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return _QUERIES | relational.QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL | relational.SQL


# --- C: text functions ---


@query("c1_tokens", f"SELECT doc_id, len(t) AS tokens, len(list_distinct(t)) AS different, t[1] AS first_token FROM (SELECT doc_id, {_TOKENS.format('text')} t FROM documents WHERE text IS NOT NULL)")
def _(s, d):
    t = table(s, d, "documents").where("text IS NOT NULL").select("doc_id", T.tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("tokens"), F.size(F.array_distinct("t")).alias("different"), F.get("t", F.lit(0)).alias("first_token"))


@query("c3_count_tokens", "SELECT DISTINCT id, token_count AS stored, len(regexp_extract_all(content, '[一-鿿㐀-䶿]')) + len(regexp_extract_all(content, '[a-zA-Z0-9]+')) AS counted FROM chunks WHERE content IS NOT NULL")
def _(s, d):
    c = table(s, d, "chunks").where("content IS NOT NULL").select("id", F.col("token_count").alias("stored"), T.count_tokens("content").alias("counted"))
    return c.distinct()


@query("c4_normalize", "SELECT toc_id, regexp_replace(lower(title), '[^a-z0-9一-鿿]+', '', 'g') AS form FROM toc_tree WHERE title IS NOT NULL")
def _(s, d):
    return table(s, d, "toc_tree").where("title IS NOT NULL").select("toc_id", T.normalize("title").alias("form"))


@query(
    "c5_collapse_lines",
    "SELECT doc_id, sha256(array_to_string(list_transform(list_filter(list_transform(range(1, len(l) + 1), lambda i: {'x': l[i], 'b': CASE WHEN i > 1 THEN l[i - 1] END}), lambda q: q.b IS NULL OR q.x <> q.b), lambda q: q.x), chr(10))) AS form FROM (SELECT doc_id, string_split(text, chr(10)) l FROM documents WHERE text IS NOT NULL)",
)
def _(s, d):
    return table(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.sha2(T.collapse_lines("text"), 256).alias("form"))


@query(
    "c6_strip_html",
    r"""SELECT item_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(table_body, '(?i)</?(?:br|p|div|tr|td|th|li|table|thead|tbody|h[1-6])(?:\s[^>]*)?/?>', ' ', 'g'), '<[^>]+>', '', 'g'),
 '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '\s+', ' ', 'g')) AS plain FROM content_list WHERE table_body IS NOT NULL""",
)
def _(s, d):
    return table(s, d, "content_list").where("table_body IS NOT NULL").select("item_id", T.strip_html("table_body").alias("plain"))


@query("c7_table_form", rf"SELECT item_id, sha256(regexp_replace(translate(translate(table_body, '{T.FULL_WIDTH}', '{T.HALF_WIDTH}'), '：（），；', ':(),;'), '\s+', '', 'g')) AS form FROM content_list WHERE table_body IS NOT NULL")
def _(s, d):
    return table(s, d, "content_list").where("table_body IS NOT NULL").select("item_id", F.sha2(T.table_form("table_body"), 256).alias("form"))


_INLINE = "{0}"
for _p in (r"\*\*([^*]+)\*\*", "__([^_]+)__", r"\*([^*]+)\*", "_([^_]+)_", "`([^`]+)`", r"\[([^\]]+)\]\([^)]+\)"):
    _INLINE = f"regexp_replace({_INLINE}, '{_p}', '\\1', 'g')"


@query("c8_clean_inline", f"SELECT DISTINCT id, sha256({_INLINE.format('content')}) AS form FROM chunks WHERE content IS NOT NULL")
def _(s, d):
    return table(s, d, "chunks").where("content IS NOT NULL").select("id", F.sha2(T.clean_inline("content"), 256).alias("form")).distinct()


_TAGS = "regexp_replace(content, '<[^>]+>', '', 'g')"
for _a, _b in T.ENTITIES:
    _TAGS = f"replace({_TAGS}, '{_a}', '{_b.replace(chr(39), chr(39) * 2)}')"


@query("c9_clean_tags", f"SELECT DISTINCT id, sha256({_TAGS}) AS form FROM chunks WHERE content IS NOT NULL")
def _(s, d):
    return table(s, d, "chunks").where("content IS NOT NULL").select("id", F.sha2(T.clean_tags("content"), 256).alias("form")).distinct()


_PROSE = _INLINE.format(r"regexp_replace(content, '(?m)^#{1,4}\s+', '', 'g')")
_PROSE = _TAGS.replace("regexp_replace(content,", f"regexp_replace({_PROSE},", 1)
_PROSE = rf"regexp_replace(regexp_replace({_PROSE}, '\n{{3,}}', chr(10) || chr(10), 'g'), ' {{2,}}', ' ', 'g')"


@query("c10_clean_prose", f"SELECT DISTINCT id, {_STRIP.format(_PROSE)} AS text FROM chunks WHERE content IS NOT NULL")
def _(s, d):
    return table(s, d, "chunks").where("content IS NOT NULL").select("id", T.clean_prose("content").alias("text")).distinct()


@query("c17_title_form", r"SELECT form, count(*) AS entries FROM (SELECT regexp_replace(title, '[\s\p{Z}\x{85}]+', '', 'g') AS form FROM toc_tree WHERE title IS NOT NULL) GROUP BY form")
def _(s, d):
    return table(s, d, "toc_tree").where("title IS NOT NULL").groupBy(T.title_form("title").alias("form")).agg(F.count("*").alias("entries"))


@query("c20_path_parts", rf"SELECT DISTINCT section, len(p) AS parts, p[1] AS first_part FROM (SELECT section, list_filter(list_transform(regexp_split_to_array(section, '[/>→]'), lambda x: {_STRIP.format('x')}), lambda x: x <> '') p FROM chunks WHERE section IS NOT NULL)")
def _(s, d):
    p = table(s, d, "chunks").where("section IS NOT NULL").select("section", T.path_parts("section").alias("p"))
    return p.select("section", F.size("p").alias("parts"), F.get("p", F.lit(0)).alias("first_part")).distinct()


@query(
    "c21_snippet",
    r"""SELECT doc_id, (CASE WHEN st > 1 THEN '…' ELSE '' END) || trim(regexp_replace(substring(text, st, place + 80 - st), '\s+', ' ', 'g')) || (CASE WHEN place + 80 <= length(text) THEN '…' ELSE '' END) AS snippet
 FROM (SELECT doc_id, text, place, greatest(place - 80, 1) st FROM (SELECT doc_id, text, least(coalesce(nullif(strpos(lower(text), 'fuse'), 0), 2147483647), coalesce(nullif(strpos(lower(text), '保险丝'), 0), 2147483647)) place FROM documents) WHERE place < 2147483647)""",
)
def _(s, d):
    return table(s, d, "documents").select("doc_id", T.snippet("text", ["fuse", "保险丝"]).alias("snippet")).where("snippet <> ''")


@query("c23_page_range", f"WITH {_CHUNKS} SELECT page, page_first, page_last, count(*) AS chunks FROM c GROUP BY ALL")
def _(s, d):
    return views.chunk_rows(s, d).groupBy("page", "page_first", "page_last").agg(F.count("*").alias("chunks"))


@query("c24_display_page", "SELECT toc_id, coalesce(printed_page, target_page) AS shown, package_id || printf('_p%04d', coalesce(printed_page, target_page)) AS anchor FROM toc_tree")
def _(s, d):
    page = F.coalesce("printed_page", "target_page")
    return table(s, d, "toc_tree").select("toc_id", page.alias("shown"), F.concat("package_id", F.when(page.isNotNull(), F.format_string("_p%04d", page))).alias("anchor"))


@query("c25_digest", "SELECT item_id, sha256(coalesce(package_id, '') || '|' || coalesce(segment, '') || '|' || coalesce(CAST(page_idx AS VARCHAR), '') || '|' || coalesce(text, '') || '|' || coalesce(table_body, '')) AS digest FROM content_list")
def _(s, d):
    return table(s, d, "content_list").select("item_id", T.digest("package_id", "segment", "page_idx", "text", "table_body").alias("digest"))


# --- D: page quality ---


@query(
    "d1_d2_table_signs",
    r"SELECT item_id, len(regexp_extract_all(table_body, '(?i)<td>\s*</td>')) AS empty_td, coalesce(list_max(list_transform(regexp_extract_all(table_body, '(?is)<tr[^>]*>(.*?)</tr>', 1), lambda r: len(regexp_extract_all(r, '(?i)<td[^>]*>')))), 0) AS widest FROM content_list WHERE table_body IS NOT NULL",
)
def _(s, d):
    return table(s, d, "content_list").where("table_body IS NOT NULL").select("item_id", pages.empty_cells("table_body").alias("empty_td"), pages.widest_row("table_body").alias("widest"))


@query(
    "d3_d4_signals",
    rf"""WITH {_PAGES}, {_SEEN} SELECT package_id, page, array_to_string(list_filter([CASE WHEN len(regexp_extract_all(md, '(?i)<td>\s*</td>')) >= 100 THEN 'excessive_empty_td' END,
 CASE WHEN coalesce(list_max(list_transform(regexp_extract_all(md, '(?is)<tr[^>]*>(.*?)</tr>', 1), lambda r: len(regexp_extract_all(r, '(?i)<td[^>]*>')))), 0) >= 20 THEN 'excessive_columns' END,
 CASE WHEN strlen(na) > 0 AND strlen(md) >= 4 * strlen(na) AND strlen(md) >= 20480 THEN 'volume_inflation' END], lambda x: x IS NOT NULL), ',') AS signals, strlen(md) AS md_bytes, strlen(na) AS native_bytes
 FROM (SELECT s.package_id, s.page, coalesce(p.text, '') md, coalesce(s.text, '') na FROM s LEFT JOIN p USING (package_id, page))""",
)
def _(s, d):
    j = views.seen_pages(s, d).select("package_id", "page", F.coalesce("text", F.lit("")).alias("na")).join(views.page_texts(s, d).select("package_id", "page", F.col("text").alias("t")), ["package_id", "page"], "left").withColumn("md", F.coalesce("t", F.lit("")))
    return j.select("package_id", "page", F.array_join(pages.signals("md", "na"), ",").alias("signals"), F.octet_length("md").alias("md_bytes"), F.octet_length("na").alias("native_bytes"))


@query("d5_choice")
def _(s, d):
    """The better of two readings of a table: every pair of neighbouring readings of a page."""
    m = table(s, d, "content_list").where("table_body IS NOT NULL").select("package_id", "segment", "page_idx", "item_id", F.struct(pages.empty_cells("table_body").alias("empty_td"), pages.widest_row("table_body").alias("max_td_per_row"), F.octet_length("table_body").alias("md_bytes"), F.lit(1.0).alias("text_coverage"), F.lit(0).alias("native_table_missing")).alias("m"))
    two = m.groupBy("package_id", "segment", "page_idx").agg(F.min(F.struct("item_id", "m")).alias("a"), F.max(F.struct("item_id", "m")).alias("b")).where(F.col("a.item_id") < F.col("b.item_id"))
    return two.select("package_id", "segment", "page_idx", F.col("a.item_id").alias("first_item"), F.col("b.item_id").alias("second_item"), pages.better(F.col("a.m"), F.col("b.m")).alias("choice"))


_TYPE = f"""WITH {_PAGES}, {_SEEN}, j AS (SELECT s.package_id, s.page, coalesce(s.text, '') na, coalesce(p.text, '') md, coalesce(s.types, []) types, len({_TOKENS.format("coalesce(s.text, '')")}) n FROM s LEFT JOIN p USING (package_id, page)),
t AS (SELECT package_id, page, n, CASE WHEN n = 0 THEN (CASE WHEN len({_TOKENS.format('md')}) >= 10 THEN 'text' ELSE 'no_text_layer' END) WHEN len(regexp_extract_all(na, '[.]{{4,}}\\s*\\d+')) >= 3 OR (contains(na, '目录') AND len(types) <= 5 AND n > 50) THEN 'toc'
 WHEN list_contains(types, 'image') OR n < 15 THEN 'image_or_sparse' WHEN list_contains(types, 'table') OR regexp_matches(md, '(?m)^\\|.+\\|$') THEN 'table' WHEN n >= 30 THEN 'text' ELSE 'unknown' END AS page_type FROM j)"""


def _typed(s, d):
    j = views.seen_pages(s, d).join(views.page_texts(s, d).withColumnRenamed("text", "md"), ["package_id", "page"], "left")
    return j.select("package_id", "page", pages.page_type("text", "md", F.col("types")).alias("page_type"))


@query("d9_page_type", _TYPE + " SELECT package_id, page, page_type FROM t")
def _(s, d):
    return _typed(s, d)


_MATCH = f""", a AS (SELECT package_id, page, token, count(*) n, min(pos) f FROM (SELECT package_id, page, unnest(t) token, unnest(range(0, len(t))) pos FROM (SELECT package_id, page, {_TOKENS.format("coalesce(text, '')")} t FROM s)) GROUP BY ALL),
b AS (SELECT package_id, page, token, count(*) m FROM (SELECT package_id, page, unnest({_TOKENS.format('text')}) token FROM p) GROUP BY ALL),
m AS (SELECT package_id, page, token, n, f, coalesce(m, 0) m FROM a LEFT JOIN b USING (package_id, page, token))"""


@query("e1_coverage", f"WITH {_PAGES}, {_SEEN}{_MATCH} SELECT package_id, page, sum(n) AS tokens, sum(least(n, m)) AS matched, sum(least(n, m)) / sum(n) AS coverage FROM m GROUP BY ALL")
def _(s, d):
    return pages.coverage(views.seen_pages(s, d), views.page_texts(s, d), ["package_id", "page"])


@query("e2_missing_tokens", f"WITH {_PAGES}, {_SEEN}{_MATCH}, r AS (SELECT package_id, page, token, n - m AS missing, row_number() OVER (PARTITION BY package_id, page ORDER BY n - m DESC, f) AS rank FROM m WHERE n > m) SELECT * FROM r WHERE rank <= 10")
def _(s, d):
    return pages.missing_tokens(views.seen_pages(s, d), views.page_texts(s, d), ["package_id", "page"], 10)


@query(
    "d10_h13_segments",
    _TYPE + _MATCH
    + """, cv AS (SELECT package_id, page, sum(n) tokens, sum(least(n, m)) matched FROM m GROUP BY ALL),
d AS (SELECT package_id, page, page_type, tokens, matched, CASE WHEN page_type = 'no_text_layer' THEN 'rerun' WHEN page_type IN ('toc', 'image_or_sparse') THEN 'review_only' WHEN page_type = 'table' THEN (CASE WHEN coalesce(matched / tokens >= 0.82, false) THEN 'pass' ELSE 'review_only' END)
 WHEN tokens IS NULL THEN 'skip' WHEN matched / tokens >= 0.82 THEN 'pass' ELSE 'rerun' END AS dec FROM t LEFT JOIN cv USING (package_id, page))
SELECT package_id, count(*) AS pages, count(*) FILTER (page_type = 'text') AS text_pages, count(*) FILTER (page_type = 'toc') AS toc_pages, count(*) FILTER (page_type = 'table') AS table_pages, count(*) FILTER (page_type = 'image_or_sparse') AS image_or_sparse_pages,
 count(*) FILTER (page_type = 'no_text_layer') AS no_text_layer_pages, count(*) FILTER (page_type = 'unknown') AS unknown_pages, coalesce(sum(tokens), 0) AS tokens, coalesce(sum(matched), 0) AS matched, CASE WHEN sum(tokens) > 0 THEN sum(matched) / sum(tokens) END AS coverage,
 CASE WHEN bool_or(dec = 'rerun') THEN 'rerun' WHEN sum(matched) / sum(tokens) < 0.82 THEN 'review_only' ELSE 'pass' END AS decision FROM d GROUP BY package_id""",
)
def _(s, d):
    t = _typed(s, d).join(pages.coverage(views.seen_pages(s, d), views.page_texts(s, d), ["package_id", "page"]), ["package_id", "page"], "left")
    return pages.segment_summary(t.withColumn("decision", pages.page_decision(F.col("page_type"), F.col("coverage"))), ["package_id"])


# --- D12-D15: search and reading ---


@query("d12_search_rows", "SELECT id, section FROM (SELECT DISTINCT id, section, content FROM chunks) WHERE contains(lower(concat_ws(' ', coalesce(section, ''), coalesce(content, ''))), 'fuse') AND contains(lower(concat_ws(' ', coalesce(section, ''), coalesce(content, ''))), 'holder') ORDER BY id LIMIT 25")
def _(s, d):
    rows = table(s, d, "chunks").select("id", "section", "content").distinct()
    return search.search_rows(rows, ["section", "content"], ["fuse", "holder"], [F.col("id")], 25).select("id", "section")


@query("d13_d14_search_both")
def _(s, d):
    """Chunks that hold the words, then documents, together up to 40."""
    first = search.search_texts(table(s, d, "chunks").select("id", "content").distinct(), "id", "content", ["fuse", "holder"], 25).select(F.col("id").alias("key"), "snippet")
    then = search.search_texts(table(s, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text"), "doc_id", "text", ["fuse", "holder"], 40).select(F.col("doc_id").alias("key"), "snippet")
    return search.search_both(first, then, 40).select("key", "snippet")


_RANGES = _MD + ", r AS (SELECT *, last_value(a IGNORE NULLS) OVER w pf, last_value(z IGNORE NULLS) OVER w pl FROM l WINDOW w AS (PARTITION BY package_id ORDER BY place ROWS UNBOUNDED PRECEDING))"


@query("e3_page_ranges", f"WITH {_RANGES} SELECT package_id, pf AS page_first, pl AS page_last, count(*) AS lines, sum(length(line)) AS chars FROM r GROUP BY ALL")
def _(s, d):
    r = anchors.page_ranges(views.markdown_lines(s, d), ["package_id"])
    return r.groupBy("package_id", "page_first", "page_last").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


@query("e4_page_ranges_default", f"WITH {_RANGES}, f AS (SELECT package_id, min_by(a, place) fa FROM l WHERE a IS NOT NULL GROUP BY ALL) SELECT package_id, coalesce(pf, fa, 1) AS page_first, count(*) AS lines FROM r LEFT JOIN f USING (package_id) GROUP BY ALL")
def _(s, d):
    r = anchors.page_ranges(views.markdown_lines(s, d), ["package_id"], default_first=True)
    return r.groupBy("package_id", "page_first").agg(F.count("*").alias("lines"))


_BLOCKS = _MD + ", bl AS (SELECT *, sum(CASE WHEN a IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY package_id ORDER BY place ROWS UNBOUNDED PRECEDING) b FROM l)"


@query("f1_blocks", f"WITH {_BLOCKS} SELECT package_id, b AS block_no, max(a) AS page_first, max(z) AS page_last, count(*) AS lines, sha256(string_agg(line, chr(10) ORDER BY place)) AS digest FROM bl WHERE b > 0 GROUP BY ALL")
def _(s, d):
    return anchors.blocks(views.markdown_lines(s, d), ["package_id"]).withColumn("digest", F.sha2("text", 256)).drop("text")


@query("d15_read_pages", f"WITH {_BLOCKS}, g AS (SELECT package_id, b, max(a) a, max(z) z, string_agg(line, chr(10) ORDER BY place) t FROM bl WHERE b > 0 GROUP BY ALL) SELECT package_id, count(*) AS blocks, sha256(string_agg(t, chr(10) ORDER BY b)) AS digest FROM g WHERE a <= 12 AND z >= 10 GROUP BY ALL")
def _(s, d):
    return anchors.read_pages(anchors.blocks(views.markdown_lines(s, d), ["package_id"]), ["package_id"], 10, 12).select("package_id", "blocks", F.sha2("text", 256).alias("digest"))


@query("f2_repeated_anchors", f"WITH {_MD} SELECT package_id, a AS anchor_first, z AS anchor_last, min(place) AS first_at, count(*) AS times FROM l WHERE a IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return anchors.repeated_anchors(views.markdown_lines(s, d), ["package_id"])


@query("f3_headings", f"WITH {_MD} SELECT package_id, lev AS level, count(*) AS headings, min(place) AS first_at FROM l WHERE lev IS NOT NULL GROUP BY ALL")
def _(s, d):
    return views.markdown_lines(s, d).where("level IS NOT NULL").groupBy("package_id", "level").agg(F.count("*").alias("headings"), F.min("place").alias("first_at"))


_STACK = ", ".join(f"max(CASE WHEN lev = {k} THEN place END) OVER w a{k}, last_value(CASE WHEN lev = {k} THEN title END IGNORE NULLS) OVER w t{k}" for k in range(1, 5))


@query(
    "f4_heading_paths",
    f"""WITH {_MD}, h AS (SELECT package_id, place, {_STACK} FROM l WINDOW w AS (PARTITION BY package_id ORDER BY place ROWS UNBOUNDED PRECEDING)),
q AS (SELECT package_id, place, array_to_string(list_filter([t1, CASE WHEN a2 > coalesce(a1, -1) THEN t2 END, CASE WHEN a3 > greatest(coalesce(a1, -1), coalesce(a2, -1)) THEN t3 END, CASE WHEN a4 > greatest(coalesce(a1, -1), coalesce(a2, -1), coalesce(a3, -1)) THEN t4 END], lambda x: x IS NOT NULL), ' / ') AS path FROM h)
SELECT package_id, path, count(*) AS lines FROM q GROUP BY ALL""",
)
def _(s, d):
    return anchors.heading_paths(views.markdown_lines(s, d), ["package_id"]).groupBy("package_id", "path").agg(F.count("*").alias("lines"))


_DEEP = ", ".join(f"max(CASE WHEN dep = {k} THEN place END) OVER w a{k}, last_value(CASE WHEN dep = {k} THEN title END IGNORE NULLS) OVER w t{k}" for k in range(1, 7))
_OPEN = ", ".join(f"CASE WHEN a{k} > greatest(-1, {', '.join(f'coalesce(a{j}, -1)' for j in range(1, k)) or '-1'}) THEN t{k} END" for k in range(1, 7))


@query(
    "f4_truncated_paths",
    f"""WITH {_MD}, n AS (SELECT package_id, place, lev, title, row_number() OVER (PARTITION BY package_id ORDER BY place) n FROM l WHERE lev IS NOT NULL),
m AS (SELECT *, n + least(0, min(lev - n) OVER (PARTITION BY package_id ORDER BY place)) dep FROM n), h AS (SELECT package_id, place, {_DEEP} FROM m WINDOW w AS (PARTITION BY package_id ORDER BY place ROWS UNBOUNDED PRECEDING))
SELECT package_id, place, array_to_string(list_filter([{_OPEN}], lambda x: x IS NOT NULL), ' / ') AS path FROM h""",
)
def _(s, d):
    """The path of each heading where skipped levels keep their position."""
    return anchors.truncated_paths(views.markdown_lines(s, d), ["package_id"]).select("package_id", "place", "path")


@query(
    "f6_sections",
    f"""WITH {_MD}, p1 AS (SELECT *, lev IS NOT DISTINCT FROM 2 OR a IS NOT NULL pt FROM l), p2 AS (SELECT *, sum(CAST(pt AS INT)) OVER w n, last_value(CASE WHEN lev = 2 THEN title END IGNORE NULLS) OVER w tt FROM p1 WINDOW w AS (PARTITION BY package_id ORDER BY place ROWS UNBOUNDED PRECEDING))
SELECT package_id, n AS section_no, min(place) AS place, CASE WHEN bool_or(lev IS NOT DISTINCT FROM 2) THEN 'h2' ELSE 'anchor' END AS kind, coalesce(min_by(coalesce(tt, ''), place), '') AS title, sha256({_STRIP.format("string_agg(line, chr(10) ORDER BY place)")}) AS digest FROM p2 WHERE n > 0 GROUP BY ALL""",
)
def _(s, d):
    return anchors.sections(views.markdown_lines(s, d), ["package_id"]).withColumn("digest", F.sha2("text", 256)).drop("text")


@query("g14_g15_chunking")
def _(s, d):
    """Sections of the Markdown packed into chunks of at most 384 tokens."""
    return chunking.chunks(anchors.sections(views.markdown_lines(s, d), ["package_id"]).withColumn("text", T.clean_prose("text")), ["package_id", "section_no", "title"], "text")


@query("f17_numbering", f"WITH {_CHUNKS} SELECT id, package_id || '@seq_' || lpad(CAST(n AS VARCHAR), CAST(greatest(3, length(CAST(n AS VARCHAR))) AS INT), '0') AS chunk_id FROM (SELECT id, package_id, row_number() OVER (PARTITION BY package_id ORDER BY seq) n FROM c)")
def _(s, d):
    return anchors.numbered(views.chunk_rows(s, d), ["package_id"], F.col("seq"), F.concat("package_id", F.lit("@seq_")), "chunk_id").select("id", "chunk_id")


@query("f18_merge_parts", f"WITH {_MD} SELECT package_id, seq // 256 AS volume, count(*) AS parts, sha256(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY seq)) AS digest FROM md GROUP BY ALL")
def _(s, d):
    return anchors.merge_parts(views.markdown_parts(s, d), ["package_id"], F.col("seq"), "text", volume=256).select("package_id", "volume", "parts", F.sha2("text", 256).alias("digest"))


@query("c5_repeated_lines", f"WITH {_MD} SELECT package_id, place, line FROM (SELECT *, lag(line) OVER (PARTITION BY package_id ORDER BY place) b FROM l) WHERE b = line")
def _(s, d):
    return anchors.previous_line_repeats(views.markdown_lines(s, d), ["package_id"]).select("package_id", "place", "line")


_UNITS = ", ".join(f"'{u}'" for u in T.UNITS)
_VAGUE = ", ".join(f"'{u}'" for u in T.AMBIGUOUS_UNITS)
_STATES = ", ".join(f"'{u}'" for u in T.STATE_LABELS)
_COLON_ROWS = (
    _COLON
    + rf""", k2 AS (SELECT *, CASE WHEN length(key) < 2 OR length(v) < 1 OR length(v) > 200 THEN 'ambiguous' WHEN key IN ('注意', '警告', '提示', '注') THEN 'non_business' WHEN regexp_matches(v, '{T.MAIL}') OR regexp_matches(v, '{T.PHONE}') THEN 'non_business'
  WHEN regexp_matches(key, '{T.AMBIGUOUS_COLON}') OR regexp_matches(v, '{T.AMBIGUOUS_COLON}') THEN 'ambiguous' ELSE 'business_candidate' END class, regexp_extract(v, '{T.UNIT_END}', 1) u, {_STRIP.format(f"regexp_replace({_STRIP.format(f"regexp_replace(v, '{T.UNIT_END}', '')")}, ',+$', '')")} cv FROM k1),
k3 AS (SELECT *, u IN ({_UNITS}) AND cv <> '' AND cv <> v AND (u NOT IN ({_VAGUE}) OR (NOT regexp_matches(cv, '\d+[/]\d+|\d+[-]\d+') AND regexp_matches(cv, '\d$'))) ok FROM k2 WHERE class <> 'non_business'),
k AS (SELECT package_id, place, key, CASE WHEN ok THEN cv ELSE v END AS value, CASE WHEN ok THEN u ELSE '' END AS unit,
  CASE WHEN key = '' OR regexp_matches(key, '{T.MARKER_KEY}') THEN 'marker' WHEN key IN ({_STATES}) THEN 'state_label' WHEN regexp_matches(key, '^M\d+') THEN 'spec_value' WHEN regexp_matches(key, '^\d+$') OR regexp_matches(key, '^\d+\s*[a-zA-Z·/℃²³%]+$') THEN 'local_label' ELSE 'business_key' END AS role,
  class, CASE WHEN class = 'business_candidate' AND regexp_matches(CASE WHEN ok THEN cv ELSE v END, '\d') AND ok THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN class = 'business_candidate' THEN 'draft' ELSE 'needs_review' END AS status, left(s, 200) AS evidence FROM k3)"""
)


@query("g9_c12_colon_rows", f"WITH {_COLON_ROWS} SELECT * FROM k")
def _(s, d):
    return anchors.colon_rows(views.markdown_lines(s, d), ["package_id"])


@query("h7_candidate_counts", f"WITH {_COLON_ROWS} SELECT role, confidence, status, unit, count(*) AS candidates FROM k GROUP BY ALL")
def _(s, d):
    return anchors.colon_rows(views.markdown_lines(s, d), ["package_id"]).groupBy("role", "confidence", "status", "unit").agg(F.count("*").alias("candidates"))


@query("h4_conflicts", f"WITH {_COLON_ROWS}, g AS (SELECT package_id, key, value, count(*) n, min(CAST(place AS VARCHAR)) f FROM k GROUP BY ALL), h AS (SELECT package_id, key, list_sort(list(value)) vs, list_sort(list(f)) ms, sum(n) member_count FROM g GROUP BY ALL HAVING count(*) > 1) SELECT sha256(package_id || '|' || key || '|' || array_to_string(vs, '|')) AS conflict_id, package_id, key, array_to_string(vs, ';') AS values, array_to_string(ms, ';') AS members, member_count FROM h")
def _(s, d):
    rows = anchors.colon_rows(views.markdown_lines(s, d), ["package_id"]).withColumn("m", F.col("place").cast("string"))
    return records.conflicts(rows, ["package_id", "key"], "value", "m")


@query(
    "g12_pipe_rows",
    rf"""WITH {_MD}, q AS (SELECT package_id, place, line, regexp_matches(line, '^\s*\|.*\|\s*$') pipe FROM l),
t AS (SELECT *, coalesce(last_value(CASE WHEN NOT pipe THEN place END IGNORE NULLS) OVER (PARTITION BY package_id ORDER BY place), -1) + 1 AS table_at FROM q),
p AS (SELECT package_id, table_at, CAST(place - table_at AS INT) r, list_transform(string_split(regexp_replace(regexp_replace({_STRIP.format('line')}, '^\|', ''), '\|$', ''), '|'), lambda x: {_STRIP.format('x')}) cells FROM t WHERE pipe)
SELECT b.package_id, b.table_at, b.r - 2 AS row_index, h.cells AS header, b.cells FROM p b JOIN p h ON h.package_id = b.package_id AND h.table_at = b.table_at AND h.r = 0
JOIN p u ON u.package_id = b.package_id AND u.table_at = b.table_at AND u.r = 1 AND len(list_filter(u.cells, lambda x: NOT regexp_matches(x, '^:?-+:?$'))) = 0 WHERE b.r > 1""",
)
def _(s, d):
    """Rows of Markdown pipe tables with their headers."""
    return anchors.pipe_rows(views.markdown_lines(s, d), ["package_id"])


# --- E5-E7, F5, F10-F16: tables of contents ---

_PATH = (
    _TOC
    + ", w AS (SELECT *, "
    + ", ".join(f"max(CASE WHEN depth = {k} THEN ord END) OVER w a{k}, last_value(CASE WHEN depth = {k} THEN title END IGNORE NULLS) OVER w t{k}" for k in range(4))
    + " FROM e WINDOW w AS (PARTITION BY package_id ORDER BY ord ROWS UNBOUNDED PRECEDING)), pa AS (SELECT package_id, ord, title, page, depth, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN depth >= {k} AND a{k} > greatest(-1{''.join(f', coalesce(a{j}, -1)' for j in range(k))}) THEN t{k} END" for k in range(4))
    + "], lambda x: x IS NOT NULL AND x <> ''), ' / ') AS path FROM w)"
)


@query("f5_toc_paths", f"WITH {_PATH} SELECT package_id, ord, path FROM pa")
def _(s, d):
    return toc.paths(views.toc_entries(s, d), ["package_id"]).select("package_id", "ord", "path")


@query("e6_exclusive_sections", f"WITH {_PATH}, g AS (SELECT package_id, page, count(*) n, max_by(path, ord) path FROM pa WHERE page IS NOT NULL GROUP BY ALL) SELECT package_id, page AS first, last, path FROM (SELECT *, lead(page) OVER (PARTITION BY package_id ORDER BY page) - 1 AS last FROM g) WHERE n = 1")
def _(s, d):
    return toc.exclusive_ranges(toc.paths(views.toc_entries(s, d), ["package_id"]), ["package_id"])


@query("e5_e6_section_of_page", f"WITH {_PATH}, g AS (SELECT package_id, page, count(*) n, max_by(path, ord) path FROM pa WHERE page IS NOT NULL GROUP BY ALL), x AS (SELECT * FROM (SELECT *, lead(page) OVER (PARTITION BY package_id ORDER BY page) - 1 AS last FROM g) WHERE n = 1) SELECT v.vlm_id, x.path FROM vlm_eval v JOIN x ON x.package_id = v.package_id AND v.page >= x.page AND (x.last IS NULL OR v.page <= x.last)")
def _(s, d):
    """Range join: the ranges of a package are disjoint, so a page meets the last range that begins at or before it."""
    r = toc.exclusive_ranges(toc.paths(views.toc_entries(s, d), ["package_id"]), ["package_id"])
    marks = r.select("package_id", F.col("first").alias("page"), F.lit(0).alias("ord"), F.to_json(F.struct("last", "path")).alias("path"))
    got = toc.last_path_asof(table(s, d, "vlm_eval").select("vlm_id", "package_id", "page"), marks, ["package_id"], "page")
    x = F.from_json("path", "last int, path string")
    return got.where(F.col("path").isNotNull()).withColumn("x", x).where(F.col("x.last").isNull() | (F.col("page") <= F.col("x.last"))).select("vlm_id", F.col("x.path").alias("path"))


@query("e7_last_section", f"WITH {_PATH} SELECT v.vlm_id, max_by(pa.path, pa.page * 4000000 + pa.ord) AS path FROM vlm_eval v LEFT JOIN pa ON pa.package_id = v.package_id AND pa.page <= v.page GROUP BY v.vlm_id")
def _(s, d):
    got = toc.last_path_asof(table(s, d, "vlm_eval").select("vlm_id", "package_id", "page"), toc.paths(views.toc_entries(s, d), ["package_id"]), ["package_id"], "page")
    return got.select("vlm_id", "path")


_FORM = r"regexp_replace({0}, '[\s\p{{Z}}\x{{85}}]+', '', 'g')"
_EVIDENCE = (
    f"{_PAGES}, {_TOC}, j AS (SELECT e.package_id, e.ord, {_FORM.format('e.title')} t, {_FORM.format("coalesce(p.text, '')")} b FROM e LEFT JOIN p ON p.package_id = e.package_id AND p.page = e.page WHERE e.title <> '' AND e.page IS NOT NULL), "
    "ev AS (SELECT package_id, ord, CASE WHEN contains(b, t) THEN 'found' WHEN len(list_intersect(list_distinct(string_split(t, '')), string_split(b, ''))) / len(list_distinct(string_split(t, ''))) >= 0.5 THEN 'partial' ELSE 'missing' END AS evidence FROM j)"
)


@query("e21_title_evidence", f"WITH {_EVIDENCE} SELECT package_id, ord, evidence FROM ev")
def _(s, d):
    return toc.title_evidence(views.toc_entries(s, d), views.page_texts(s, d), ["package_id"])


@query("h14_evidence_stats", f"WITH {_EVIDENCE} SELECT package_id, count(*) AS total, count(*) FILTER (evidence = 'found') AS found, count(*) FILTER (evidence = 'partial') AS partial, count(*) FILTER (evidence = 'missing') AS missing FROM ev GROUP BY package_id")
def _(s, d):
    return toc.evidence_stats(toc.title_evidence(views.toc_entries(s, d), views.page_texts(s, d), ["package_id"]), ["package_id"])


_RUNS = "q AS (SELECT DISTINCT package_id, toc_page p FROM toc_tree WHERE toc_page IS NOT NULL), g AS (SELECT package_id, p, p - row_number() OVER (PARTITION BY package_id ORDER BY p) k FROM q), runs AS (SELECT package_id, min(p) AS first_page, max(p) AS last_page FROM g GROUP BY package_id, k)"


@query("f10_toc_runs", f"WITH {_RUNS} SELECT package_id, first_page, last_page, last_page - first_page + 1 AS pages FROM runs")
def _(s, d):
    return toc.toc_page_runs(table(s, d, "toc_tree"), ["package_id"])


@query("f11_main_run", f"WITH {_RUNS}, n AS (SELECT runs.*, count(*) entries FROM runs JOIN toc_tree t ON t.package_id = runs.package_id AND t.toc_page BETWEEN first_page AND last_page GROUP BY ALL) SELECT package_id, first_page, last_page, entries FROM (SELECT *, row_number() OVER (PARTITION BY package_id ORDER BY entries DESC, first_page) r FROM n) WHERE r = 1")
def _(s, d):
    t = table(s, d, "toc_tree")
    return toc.main_run(toc.toc_page_runs(t, ["package_id"]), t, ["package_id"])


@query("f12_cluster", "WITH v AS (SELECT DISTINCT event_type, round(value, 1) x FROM events WHERE value IS NOT NULL), g AS (SELECT *, CASE WHEN x - lag(x) OVER w > 8 THEN 1 ELSE 0 END n FROM v WINDOW w AS (PARTITION BY event_type ORDER BY x)), k AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY x ROWS UNBOUNDED PRECEDING) c FROM g), m AS (SELECT event_type, c, avg(x) m FROM k GROUP BY ALL) SELECT k.event_type, k.x, min_by(m.c, {'d': abs(k.x - m.m), 'c': m.c}) AS depth FROM k JOIN m USING (event_type) GROUP BY ALL")
def _(s, d):
    return sequences.cluster_1d(table(s, d, "events"), ["event_type"], "value")


@query("f16_toc_lines", f"WITH {_TOC} SELECT package_id, ord, repeat('  ', greatest(depth, 0)) || '- ' || title || coalesce(' ... ' || page, '') AS line FROM e")
def _(s, d):
    return toc.markdown_lines(views.toc_entries(s, d), ["package_id"])


@query("f14_f15_dotted_entries", f"WITH {_TOC} SELECT package_id, ord * 2 + ord % 2 AS place, {_STRIP.format('title')} AS title, page FROM e WHERE title <> '' AND page IS NOT NULL")
def _(s, d):
    """Entries read back from the printed form of the table of contents."""
    e = views.toc_entries(s, d).where("title <> '' AND page IS NOT NULL").withColumn("place", F.col("ord").cast("long") * 2)
    whole = e.where("ord % 2 = 0").select("package_id", "place", F.format_string("%s ..... %d", "title", "page").alias("line"))
    split = e.where("ord % 2 = 1").select("package_id", F.explode(F.array(F.struct("place", F.concat("title", F.lit(" .....")).alias("line")), F.struct((F.col("place") + 1).alias("place"), F.format_string("..... %d", "page").alias("line")))).alias("x")).select("package_id", "x.place", "x.line")
    return toc.dotted_entries(whole.unionAll(split), ["package_id"])


@query("h22_depths", f"WITH {_TOC}, g AS (SELECT package_id, depth, count(*) n FROM e GROUP BY ALL) SELECT package_id, string_agg(depth || ':' || n, ', ' ORDER BY depth) AS depths FROM g GROUP BY ALL")
def _(s, d):
    return toc.depth_distribution(views.toc_entries(s, d), ["package_id"])


@query("i18_numbering", "WITH o AS (SELECT package_id, target_page - printed_page o, count(*) n FROM toc_tree WHERE target_page IS NOT NULL AND printed_page IS NOT NULL GROUP BY ALL), b AS (SELECT package_id, sum(n) entries, max({'n': n, 'near': -abs(o), 'o': o}) b FROM o GROUP BY ALL), p AS (SELECT DISTINCT package_id FROM toc_tree) SELECT package_id, coalesce(entries, 0) AS entries, b.o AS offset, coalesce(b.n, 0) AS agreeing, CASE WHEN entries IS NULL THEN 'unknown' WHEN b.n / entries >= 0.9 THEN (CASE WHEN b.o = 0 THEN 'identity' ELSE 'constant_offset' END) ELSE 'piecewise' END AS mapping FROM p LEFT JOIN b USING (package_id)")
def _(s, d):
    return toc.numbering(table(s, d, "toc_tree"), ["package_id"])


# --- G: grids ---


def _bodies(s, d):
    return table(s, d, "content_list").where("table_body IS NOT NULL").select("item_id", "table_body")


@query("g1_cells")
def _(s, d):
    return grids.cells(_bodies(s, d), "item_id", "table_body")


@query(
    "g1_row_sizes",
    r"""WITH b AS (SELECT item_id, list_transform(string_split_regex(regexp_replace(table_body, '(?i)</t[dh]\b[^>]*>', '', 'g'), '(?i)</?(?:tr|thead|tbody|tfoot)\b[^>]*>'), lambda x: len(string_split_regex(x, '(?i)<t[dh]\b[^>]*>')) - 1) n FROM content_list WHERE regexp_matches(table_body, '(?i)<table')),
r AS (SELECT item_id, list_filter(n, lambda x: x > 0) n FROM b) SELECT item_id, CAST(unnest(range(0, len(n))) AS INT) AS row_no, unnest(n) AS cells FROM r""",
)
def _(s, d):
    """Numbers of cells of the rows of each table; table bodies hold one table each."""
    return grids.cells(_bodies(s, d), "item_id", "table_body").groupBy("item_id", "row_no").agg(F.count("*").alias("cells"))


@query("g2_filled_cells")
def _(s, d):
    return grids.cells(_bodies(s, d), "item_id", "table_body", fill=True)


@query("h3_table_structure")
def _(s, d):
    return grids.structure(_bodies(s, d), "item_id", "table_body")


@query("f7_parent_labels")
def _(s, d):
    return grids.parent_labels(_bodies(s, d), "item_id", "table_body")


@query("g10_key_values")
def _(s, d):
    return grids.key_values(_bodies(s, d), "item_id", "table_body", key_words=T.KEY_WORDS)


@query("g13_table_sentences")
def _(s, d):
    return grids.sentences(_bodies(s, d), "item_id", "table_body")


@query("g19_narrowed")
def _(s, d):
    return grids.narrowed(_bodies(s, d), "item_id", "table_body", 4)


@query("g20_formatted")
def _(s, d):
    return grids.formatted(_bodies(s, d), "item_id", "table_body")


@query("g21_structure_differences")
def _(s, d):
    """Each table against itself with a unit written in another way and without its last row."""
    t = _bodies(s, d)
    after = t.select("item_id", F.regexp_replace(F.regexp_replace("table_body", r"\brpm\b", "1/min"), r"(?is)<tr\b(?:(?!<tr\b).)*$", "").alias("table_body"))
    return grids.structure_differences(grids.cells(t, "item_id", "table_body"), grids.cells(after, "item_id", "table_body"), "item_id")


# --- H, I, J: records, identities, checks ---


@query("h21_duplicates", "SELECT package_id, segment, page_idx, type, text, table_body, img_path, count(*) AS n FROM content_list GROUP BY ALL HAVING count(*) > 1")
def _(s, d):
    return records.duplicates(table(s, d, "content_list"), ["package_id", "segment", "page_idx", "type", "text", "table_body", "img_path"])


@query("h19_package_stats", "SELECT package_id, count(*) AS items, count(*) FILTER (type = 'table') AS tables, count(*) FILTER (type = 'text') AS texts, count(*) FILTER (type = 'image') AS images, count(*) FILTER (type = 'equation') AS equations, count(DISTINCT segment) AS segments, count(*) FILTER (page_idx IS NULL) AS without_page FROM content_list GROUP BY ALL")
def _(s, d):
    kinds = {"tables": "table", "texts": "text", "images": "image", "equations": "equation"}
    return table(s, d, "content_list").groupBy("package_id").agg(F.count("*").alias("items"), *[F.count_if(F.col("type") == v).alias(k) for k, v in kinds.items()], F.countDistinct("segment").alias("segments"), F.count_if(F.col("page_idx").isNull()).alias("without_page"))


@query("a9_segments", r"SELECT DISTINCT package_id, segment, CAST(regexp_extract(segment, '^p(\d{4,})-(\d{4,})$', 1) AS INT) AS start_page, CAST(regexp_extract(segment, '^p(\d{4,})-(\d{4,})$', 2) AS INT) AS end_page FROM content_list WHERE regexp_full_match(segment, 'p\d{4,}-\d{4,}')")
def _(s, d):
    name = r"^p(\d{4,})-(\d{4,})$"
    c = table(s, d, "content_list").where(F.col("segment").rlike(name)).select("package_id", "segment").distinct()
    return c.select("package_id", "segment", F.regexp_extract("segment", name, 1).try_cast("int").alias("start_page"), F.regexp_extract("segment", name, 2).try_cast("int").alias("end_page"))


@query("i1_i2_identity", "SELECT item_id, h AS row_hash, sha256(coalesce(package_id, '') || '|' || coalesce(segment, '') || '|' || coalesce(CAST(page_idx AS VARCHAR), '') || '|' || h) AS record_id FROM (SELECT *, sha256(coalesce(type, '') || '|' || coalesce(text, '') || '|' || coalesce(table_body, '') || '|' || coalesce(img_path, '')) h FROM content_list)")
def _(s, d):
    return records.with_identity(table(s, d, "content_list"), ["type", "text", "table_body", "img_path"], ["package_id", "segment", "page_idx"]).select("item_id", "row_hash", "record_id")


@query("i3_candidate_id", "SELECT item_id, sha256(CASE WHEN coalesce(segment, '') || coalesce(CAST(page_idx AS VARCHAR), '') = '' THEN j || '|' || h ELSE j END) AS candidate_id FROM (SELECT item_id, segment, page_idx, 'item-v1|' || coalesce(package_id, '') || '|' || coalesce(type, '') || '|' || coalesce(segment, '') || '|' || coalesce(CAST(page_idx AS VARCHAR), '') j, sha256(coalesce(text, '')) h FROM content_list)")
def _(s, d):
    return table(s, d, "content_list").select("item_id", records.candidate_id("item-v1", ["package_id", "type", "segment", "page_idx"], T.digest("text")).alias("candidate_id"))


@query("i7_collisions", "WITH g AS (SELECT package_id, ord, sha256(coalesce(title, '') || '|' || coalesce(CAST(target_page AS VARCHAR), '')) h, count(*) n FROM toc_tree GROUP BY ALL) SELECT package_id, ord, sum(n) AS rows, count(*) AS contents, CASE WHEN count(*) = 1 THEN 'same' ELSE 'different' END AS kind FROM g GROUP BY package_id, ord HAVING sum(n) > 1")
def _(s, d):
    return records.collisions(table(s, d, "toc_tree"), ["package_id", "ord"], ["title", "target_page"])


@query("h6_batch", "WITH c AS (SELECT DISTINCT id, package_id FROM chunks), b AS (SELECT package_id, CAST('0x' || substr(sha256(coalesce(id, '')), 1, 4) AS INT) % 65536 b, count(*) n, sha256(string_agg(id, ',' ORDER BY id)) h FROM c GROUP BY ALL) SELECT package_id, sum(n) AS records, sha256(coalesce(package_id, '') || '|' || string_agg(h, ',' ORDER BY b)) AS batch_id FROM b GROUP BY package_id")
def _(s, d):
    return records.batch_id(table(s, d, "chunks").select("id", "package_id").distinct(), "package_id", "id")


@query("i8_latest", "SELECT package_id, page, max(vlm_id) AS vlm_id, max_by(parse_status, {'t': evaluated_at, 'v': vlm_id}) AS parse_status FROM (SELECT package_id, page, vlm_id, parse_status, evaluated_at FROM vlm_eval) GROUP BY ALL")
def _(s, d):
    v = table(s, d, "vlm_eval")
    return v.groupBy("package_id", "page").agg(F.max("vlm_id").alias("vlm_id"), F.max_by("parse_status", F.struct("evaluated_at", "vlm_id")).alias("parse_status"))


@query("e10_without_page_text", f"WITH {_PAGES}, {_SEEN} SELECT package_id, page FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.package_id = s.package_id AND p.page = s.page)")
def _(s, d):
    return views.seen_pages(s, d).join(views.page_texts(s, d), ["package_id", "page"], "left_anti").select("package_id", "page")


@query("e11_carried", "SELECT a.toc_id, coalesce(b.printed_page, a.printed_page) AS printed_page FROM toc_tree a LEFT JOIN (SELECT toc_id, printed_page FROM toc_tree WHERE depth = 0) b USING (toc_id)")
def _(s, d):
    t = table(s, d, "toc_tree").select("toc_id", "printed_page")
    return records.carried(t, table(s, d, "toc_tree").where("depth = 0"), "toc_id", ["printed_page"])


_VLM = "CASE WHEN NOT coalesce({0}, false) THEN '{1}' END"
_VLM_RULES = ", ".join(
    _VLM.format(sql, name)
    for name, sql in {
        "status_known": "parse_status IN ('ok', 'failed')", "page_positive": "page >= 1", "summary_present": "parse_status <> 'ok' OR coalesce(page_summary, '') <> ''", "confidence_in_range": "parse_status <> 'ok' OR confidence BETWEEN 0 AND 1",
        "elements_named": "len(list_filter(coalesce(visual_elements, []), lambda e: coalesce(e.type, '') = '')) = 0", "key_text_present": "len(list_filter(coalesce(key_text, []), lambda t: coalesce(t, '') = '')) = 0", "error_only_if_failed": "parse_status = 'ok' OR error IS NOT NULL",
    }.items()
)


@query("d22_j2_vlm_violations", f"SELECT vlm_id, r AS rule FROM (SELECT vlm_id, unnest([{_VLM_RULES}]) r FROM vlm_eval) WHERE r IS NOT NULL")
def _(s, d):
    return checks.violations(table(s, d, "vlm_eval"), "vlm_id", checks.vlm_rules())


@query("d22_repaired_vlm", "SELECT vlm_id, coalesce(page_summary, '') AS page_summary, array_to_string(list_filter(coalesce(key_text, []), lambda t: coalesce(t, '') <> ''), '|') AS key_text, least(greatest(confidence, 0.0), 1.0) AS confidence, coalesce(parse_status = 'ok' AND page_summary IS NOT NULL AND confidence BETWEEN 0 AND 1, false) AS valid FROM vlm_eval")
def _(s, d):
    r = checks.repaired_vlm(table(s, d, "vlm_eval"), "vlm_id")
    return r.select("vlm_id", "page_summary", F.array_join("key_text", "|").alias("key_text"), "confidence", F.coalesce("valid", F.lit(False)).alias("valid"))


@query("j13_missing_pages", f"WITH {_SEEN} SELECT package_id, page FROM (SELECT package_id, CAST(unnest(range(1, page_count + 1)) AS INT) AS page FROM packages WHERE page_count >= 1) EXCEPT SELECT package_id, page FROM s")
def _(s, d):
    return checks.missing_pages(views.seen_pages(s, d), ["package_id"], "page", table(s, d, "packages").select("package_id", "page_count"), "page_count")


@query("h25_listing_difference", "SELECT coalesce(a.id, b.id) AS path, CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' ELSE 'changed' END AS change FROM (SELECT DISTINCT id, sha256(coalesce(content, '')) h FROM chunks) a FULL JOIN (SELECT DISTINCT id, sha256(trim(coalesce(content, ''), ' ')) h FROM chunks WHERE section IS NOT NULL) b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL OR a.h <> b.h")
def _(s, d):
    c = table(s, d, "chunks")
    a = c.select("id", F.sha2(F.coalesce("content", F.lit("")), 256).alias("h")).distinct()
    b = c.where("section IS NOT NULL").select("id", F.sha2(F.trim(F.coalesce("content", F.lit(""))), 256).alias("h")).distinct()
    return checks.tree_difference(a, b, "id", "h")


_TRADE = "t AS (SELECT c_nationkey AS src, s_nationkey AS dst, count(*) n FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE c_nationkey <> s_nationkey GROUP BY ALL), e AS (SELECT src, max({'n': n, 'd': dst}).d AS dst FROM t GROUP BY src)"


@query("k5_cycles", f"WITH RECURSIVE {_TRADE}, r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON r.dst = e.src) SELECT DISTINCT src AS node FROM r WHERE src = dst")
def _(s, d):
    """Nations that lie on a circle of main suppliers: each nation points at the other nation from which most of its lines come."""
    li = table(s, d, "lineitem").join(table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(s, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    t = li.where("c_nationkey <> s_nationkey").groupBy("c_nationkey", "s_nationkey").agg(F.count("*").alias("n"))
    return records.cycles(t.groupBy(F.col("c_nationkey").alias("src")).agg(F.max(F.struct("n", F.col("s_nationkey").alias("d")))["d"].alias("dst")))


# --- cleaning, links, patches, words ---


@query("c10_c11_clean_markdown")
def _(s, d):
    """Chunks cleaned for embedding: images, tables, headings and inline marks to plain text."""
    return table(s, d, "chunks").where("content IS NOT NULL").select("id", "content").distinct().select("id", cleaning.clean_markdown("content").alias("text"))


_HINT_CASE = "CASE " + " ".join(f"WHEN contains(lower(src), '{k}') THEN '{v}'" for k, v in cleaning.HINTS.items()) + " END"


@query("c11_image_hints", f"SELECT item_id, '[示意图' || coalesce('：' || {_HINT_CASE}, '') || ']' AS label FROM (SELECT item_id, split_part(img_path, '/', -1) AS src FROM content_list WHERE img_path IS NOT NULL AND img_path <> '' AND NOT contains(img_path, ')'))")
def _(s, d):
    i = table(s, d, "content_list").where("img_path IS NOT NULL AND img_path <> '' AND NOT contains(img_path, ')')")
    return i.select("item_id", cleaning.image_labels(F.concat(F.lit("![]("), "img_path", F.lit(")"))).alias("label"))


@query("g16_json_texts", "SELECT vlm_id, list_filter(coalesce(key_text, []), lambda t: t IS NOT NULL) AS texts FROM vlm_eval")
def _(s, d):
    """Key texts written as nested JSON elements and walked back out of it."""
    v = table(s, d, "vlm_eval").select("vlm_id", F.filter(F.coalesce("key_text", F.array().cast("array<string>")), lambda t: t.isNotNull()).alias("k"))
    j = v.select("vlm_id", F.to_json(F.struct(F.transform("k", lambda t: F.struct(F.lit("text").alias("type"), t.alias("content"))).alias("page"))).alias("j"))
    return cleaning.json_texts(j, ["vlm_id"], "j")


_LINK = r"\[([^\]\n]*)\]\(([^)\s]+)\)"


@query("k4_links", f"WITH {_MD}, x AS (SELECT package_id, place, unnest(regexp_extract_all(line, '(?:^|[^!]){_LINK}', 1)) AS label, unnest(regexp_extract_all(line, '(?:^|[^!]){_LINK}', 2)) AS target FROM l) SELECT package_id, place, label, target, CASE WHEN starts_with(target, '#') THEN 'anchor' WHEN regexp_matches(target, '^[a-z][a-z0-9+.-]*:') THEN 'external' ELSE 'path' END AS kind FROM x")
def _(s, d):
    return cleaning.links(views.markdown_lines(s, d), ["package_id"])


@query("i15_apply_fixes")
def _(s, d):
    """Every heading of a page block written larger by a correction, in order, in the blocks that hold it."""
    b = anchors.blocks(views.markdown_lines(s, d), ["package_id"])
    f = b.where(F.col("text").contains("## ")).select("package_id", F.col("page_first").alias("page"), F.col("block_no").alias("ord"), F.lit("## ").alias("before"), F.lit("# ").alias("after"), F.lit(None).cast("int").alias("expected"))
    return patches.apply_fixes(b, f, ["package_id"]).select("package_id", "block_no", "applied", "refused", F.sha2("text", 256).alias("digest"))


_SIGNS = r"[CASE WHEN len(regexp_extract_all(table_body, '(?i)<td>\s*</td>')) > 2 THEN 'excessive_empty_td' END, CASE WHEN coalesce(list_max(list_transform(regexp_extract_all(table_body, '(?is)<tr[^>]*>(.*?)</tr>', 1), lambda r: len(regexp_extract_all(r, '(?i)<td[^>]*>')))), 0) > 4 THEN 'excessive_columns' END, CASE WHEN strlen(table_body) > 800 THEN 'volume_inflation' END]"


@query(
    "d16_d17_candidates",
    f"""WITH q AS (SELECT package_id, page_idx + 1 AS page, table_body, list_filter({_SIGNS}, lambda x: x IS NOT NULL) s FROM content_list WHERE table_body IS NOT NULL AND page_idx IS NOT NULL),
k AS (SELECT *, list_has_any(s, ['excessive_empty_td', 'excessive_columns']) shape, list_contains(s, 'volume_inflation') inflated FROM q WHERE len(s) > 0)
SELECT package_id, page, package_id || '_p' || lpad(CAST(page AS VARCHAR), CAST(greatest(4, len(CAST(page AS VARCHAR))) AS INT), '0') AS candidate_id, CASE WHEN shape AND inflated THEN 'mixed' WHEN shape THEN 'structural' WHEN inflated THEN 'text_omission' ELSE 'unknown' END AS type, array_to_string(s, ',') AS signals
FROM k WHERE shape OR regexp_matches(table_body, '(?i)<table')""",
)
def _(s, d):
    """Table pages with signals: every table with its page, its signals and its type."""
    t = table(s, d, "content_list").where("table_body IS NOT NULL AND page_idx IS NOT NULL")
    p = t.select("package_id", (F.col("page_idx") + 1).alias("page"), "table_body", F.array_compact(F.array(F.when(pages.empty_cells("table_body") > 2, "excessive_empty_td"), F.when(pages.widest_row("table_body") > 4, "excessive_columns"), F.when(F.octet_length("table_body") > 800, "volume_inflation"))).alias("signals"))
    return patches.candidates(p, "package_id", "page", "signals", "table_body")


@query("d21_parents", rf"WITH {_PATH}, q AS (SELECT package_id, ord, regexp_extract(title, '([A-Z]\d+[A-Z])', 1) k, list_filter(list_transform(regexp_split_to_array(path, '[/>→]'), lambda x: {_STRIP.format('x')}), lambda x: x <> '') p FROM pa) SELECT package_id, ord, k AS key, p[-1] AS parent FROM q WHERE len(p) >= 2 AND k <> '' AND NOT list_contains(p, k)")
def _(s, d):
    """The section above each part number in a title of the second level or deeper."""
    e = toc.paths(views.toc_entries(s, d), ["package_id"]).withColumn("key", F.regexp_extract("title", r"([A-Z]\d+[A-Z])", 1))
    return e.select("package_id", "ord", "key", patches.parent_suggestion(T.path_parts("path"), F.col("key"), F.lit("")).alias("parent")).where("parent IS NOT NULL")


@query("f13_visual_lines", "SELECT vlm_id, len(k) AS lines, len(k) AS words FROM (SELECT vlm_id, list_filter(coalesce(key_text, []), lambda t: coalesce(trim(t, ' '), '') <> '' AND NOT regexp_matches(trim(t, ' '), '^\\d+$')) k FROM vlm_eval)")
def _(s, d):
    """Key texts laid out one below the other come back as one visual line each."""
    w = F.transform(F.coalesce("key_text", F.array().cast("array<string>")), lambda t, i: F.struct(F.lit(10.0).alias("x0"), (i * 20.0).alias("y0"), F.lit(90.0).alias("x1"), (i * 20.0 + 12).alias("y1"), F.coalesce(t, F.lit("")).alias("text")))
    v = table(s, d, "vlm_eval").select("vlm_id", words.visual_lines(w, F.lit(10000.0)).alias("lines"))
    return v.select("vlm_id", F.size("lines").alias("lines"), F.size(F.flatten("lines")).alias("words"))


@query("g18_table_omissions")
def _(s, d):
    """First-column texts that a table lacks: each table against its own words with two more on its first row."""
    t = table(s, d, "content_list").where("table_body IS NOT NULL").select("item_id", "table_body")
    w = F.array(*[F.struct(F.lit(x).alias("x0"), F.lit(100.0).alias("y0"), F.lit(x + 30).alias("x1"), F.lit(110.0).alias("y1"), v.alias("text")) for x, v in ((20.0, F.lit("Lost label")), (300.0, F.regexp_extract("table_body", r"(?i)<t[dh][^>]*>([^<]+)<", 1)))])
    return words.table_omissions(t.select("item_id", "table_body", w.alias("words"), F.lit(600.0).alias("width"), F.lit(800.0).alias("height")), ["item_id"], "table_body", "words", "width", "height")


@query(
    "e22_exact_pages",
    f"""WITH {_PAGES}, {_PATH}, r AS (SELECT package_id, ord, regexp_extract(title, '([A-Z]\\d+[A-Z])', 1) AS key, page, coalesce(page, 0) + 3 AS page_last, title FROM pa),
q AS (SELECT r.package_id, r.ord, p.page, (r.page IS NOT NULL AND p.page BETWEEN r.page AND r.page_last) AS scoped, len(list_filter(list_distinct(regexp_split_to_array(r.title, '\\s+')), lambda w: w <> '' AND contains(p.text, w))) AS score
  FROM r JOIN p ON p.package_id = r.package_id AND contains(p.text, r.key) WHERE r.key <> ''),
z AS (SELECT *, row_number() OVER (PARTITION BY package_id, ord ORDER BY scoped DESC, score DESC, page) k FROM q)
SELECT package_id || ':' || ord AS entry, page, scoped FROM z WHERE k = 1""",
)
def _(s, d):
    """The page on which the part number of each title stands, near the title's own page if it does there."""
    e = views.toc_entries(s, d)
    r = e.select("package_id", F.concat("package_id", F.lit(":"), F.col("ord").cast("string")).alias("entry"), F.regexp_extract("title", r"([A-Z]\d+[A-Z])", 1).alias("key"), F.col("page").alias("page_first"), (F.col("page") + 3).alias("page_last"), F.col("title").alias("evidence"))
    return lookup.exact_pages(r, views.page_texts(s, d), ["package_id"], "entry")


@query("e20_physical_pages")
def _(s, d):
    """Entries of which every second one lost its page, put back on the pages of the printed table."""
    t = table(s, d, "toc_tree")
    listed = t.select("package_id", F.col("toc_page").alias("page"), "title")
    e = t.groupBy("package_id", "ord").agg(F.min(F.struct("title", "toc_page")).alias("x")).select("package_id", "ord", "x.title", F.when(F.col("ord") % 2 == 0, F.col("x.toc_page")).alias("toc_page"))
    return lookup.physical_pages(e, listed, ["package_id"])


@query("h20_title_recall", f"WITH {_PAGES}, {_TOC}, t AS (SELECT DISTINCT package_id, title FROM e WHERE title <> ''), y AS (SELECT DISTINCT package_id, toc_page AS page FROM toc_tree WHERE toc_page IS NOT NULL) SELECT package_id, page, count(*) FILTER (contains(p.text, t.title)) AS found, count(*) AS titles, round(count(*) FILTER (contains(p.text, t.title)) / count(*), 4) AS recall FROM p JOIN y USING (package_id, page) JOIN t USING (package_id) GROUP BY ALL")
def _(s, d):
    p = views.page_texts(s, d).join(table(s, d, "toc_tree").where("toc_page IS NOT NULL").select("package_id", F.col("toc_page").alias("page")).distinct(), ["package_id", "page"])
    return lookup.title_recall(views.toc_entries(s, d), p, ["package_id"])


# --- audits and reports ---


def _audit(s, d):
    rows = audit.source_rows(grids.cells(_bodies(s, d), "item_id", "table_body"), "item_id")
    return audit.covered(rows, grids.key_values(_bodies(s, d), "item_id", "table_body", key_words=T.KEY_WORDS), "item_id")


@query("g7_e9_source_rows")
def _(s, d):
    """Rows of the tables with the candidates that were extracted from them."""
    return _audit(s, d)


@query("h17_table_coverage")
def _(s, d):
    return audit.by_table(_audit(s, d), "item_id")


@query("d20_gaps")
def _(s, d):
    return audit.gaps(_audit(s, d), "item_id")


@query("h8_h11_page_report", f"WITH {_PAGES}, {_SEEN}{_MATCH}, cv AS (SELECT package_id, page, sum(least(n, m)) / sum(n) c FROM m GROUP BY ALL), lack AS (SELECT package_id, page, string_agg(token || ':' || missing, ', ' ORDER BY missing DESC, f) AS lacks FROM (SELECT *, n - m AS missing, row_number() OVER (PARTITION BY package_id, page ORDER BY n - m DESC, f) k FROM m WHERE n > m) WHERE k <= 5 GROUP BY ALL) SELECT package_id, page, round(c, 4) AS coverage, coalesce(lacks, '') AS lacks FROM cv LEFT JOIN lack USING (package_id, page) WHERE c < 0.82")
def _(s, d):
    """Pages below the threshold with the five tokens that they lack most."""
    native, seen = views.seen_pages(s, d), views.page_texts(s, d)
    low = pages.coverage(native, seen, ["package_id", "page"]).where("coverage < 0.82")
    top = pages.missing_tokens(native, seen, ["package_id", "page"], 5).groupBy("package_id", "page").agg(F.array_sort(F.collect_list(F.struct("rank", F.concat("token", F.lit(":"), F.col("missing").cast("string")).alias("t")))).alias("x"))
    return low.join(top, ["package_id", "page"], "left").select("package_id", "page", F.round("coverage", 4).alias("coverage"), F.coalesce(F.array_join(F.transform("x", lambda v: v["t"]), ", "), F.lit("")).alias("lacks"))


@query("k6_overlapping", "SELECT section AS path, count(DISTINCT package_id) AS owners FROM chunks WHERE section IS NOT NULL GROUP BY section HAVING count(DISTINCT package_id) > 1")
def _(s, d):
    return audit.overlapping(table(s, d, "chunks").where("section IS NOT NULL").select("package_id", F.col("section").alias("path")), "package_id", "path")


@query("k7_stale", "SELECT package_id, date_diff('day', CAST(created_at AS DATE), DATE '2026-01-01') AS age FROM packages WHERE created_at IS NULL OR date_diff('day', CAST(created_at AS DATE), DATE '2026-01-01') > 90")
def _(s, d):
    return audit.stale(table(s, d, "packages"), "package_id", "created_at", F.lit("2026-01-01").cast("date"), 90)


@query("e19_unresolved", "SELECT DISTINCT segment FROM content_list WHERE coalesce(segment, '') <> '' AND segment NOT IN (SELECT segment FROM content_list WHERE type = 'table' AND segment IS NOT NULL)")
def _(s, d):
    """Segments that are named but have no table."""
    c = table(s, d, "content_list")
    return audit.unresolved_references(c.select(F.col("segment").alias("ref")), c.where("type = 'table'"), "segment", "ref").select(F.col("ref").alias("segment")).distinct()


# --- identity by source position ---

_POSITION = """x AS (SELECT item_id, sha256(package_id) h, CASE type WHEN 'table' THEN 'html_table' WHEN 'text' THEN 'paragraph' ELSE type END || ':' || item_id b, coalesce(CAST(page_idx AS VARCHAR), '') r FROM content_list),
y AS (SELECT *, regexp_extract(b, '^(html_table|md_table|paragraph):(\\d+)$', 1) kind, regexp_extract(b, '^(html_table|md_table|paragraph):(\\d+)$', 2) n FROM x),
z AS (SELECT *, CASE WHEN coalesce(h, '') = '' THEN 'source_hash' WHEN kind = '' THEN 'source_position' WHEN kind = 'paragraph' AND r NOT IN ('', '0') THEN 'paragraph_row' WHEN kind <> 'paragraph' AND (r = '' OR TRY_CAST(r AS INT) < 1) THEN 'table_row' END AS error FROM y)""".replace("\\\\", "\\")


@query("i4_source_anchors", f"WITH {_POSITION} SELECT item_id, error, CASE WHEN error IS NULL THEN sha256('candidate-v2|' || h || '|' || kind || '|' || n || '|' || CASE WHEN kind = 'paragraph' THEN '0' ELSE r END || '|0') END AS candidate_id FROM z")
def _(s, d):
    """Ids of items by where they stand; items whose position says too little keep the rule they break."""
    kind = F.when(F.col("type") == "table", "html_table").when(F.col("type") == "text", "paragraph").otherwise(F.col("type"))
    a = identity.source_anchor(F.sha2("package_id", 256), F.concat(kind, F.lit(":"), F.col("item_id").cast("string")), F.lit(""), F.col("page_idx").cast("string"))
    return table(s, d, "content_list").select("item_id", a.alias("a")).select("item_id", F.col("a.error").alias("error"), identity.anchored_id(F.col("a.anchor")).alias("candidate_id"))


@query("i5_content_hash", "SELECT item_id, sha256('candidate-content-v1|' || coalesce(package_id, '') || '|' || coalesce(segment, '') || '|' || coalesce(type, '') || '|' || coalesce(text, '') || '|' || coalesce(table_body, '') || '|' || coalesce(img_path, '') || '||' || sha256(coalesce(text, ''))) AS v1, sha256('candidate-review-v2|' || item_id || '|' || coalesce(text, '') || '|' || coalesce(table_body, '') || '|' || coalesce(img_path, '') || '|') AS v2 FROM content_list")
def _(s, d):
    """Digests of the content of items, of both versions."""
    none = F.lit(None).cast("string")
    c = {"source_pdf": F.col("package_id"), "model": F.col("segment"), "section_path": F.col("type"), "key": F.col("text"), "value": F.col("table_body"), "unit": F.col("img_path"), "evidence_text": none, "row_hash": T.digest("text"), "candidate_id": F.col("item_id")}
    return table(s, d, "content_list").select("item_id", identity.content_hash(1, c).alias("v1"), identity.content_hash(2, c).alias("v2"))


@query("d24_numbering_safety", "SELECT package_id, coalesce(numbering_status = 'verified', false) AS safe, CASE WHEN numbering_status IS NULL AND numbering_mapping IS NULL THEN 'missing' ELSE coalesce(numbering_status, 'needs_review') END AS status, CASE WHEN numbering_status IS NULL AND numbering_mapping IS NULL THEN 'numbering_missing' WHEN numbering_status = 'verified' THEN NULL WHEN coalesce(numbering_mapping, 'unknown') = 'unknown' THEN 'mapping_unknown' ELSE 'offset_unverified' END AS warning FROM packages")
def _(s, d):
    return table(s, d, "packages").select("package_id", identity.numbering_safety("numbering_status", "numbering_mapping").alias("x")).select("package_id", "x.safe", "x.status", "x.warning")


@query(
    "e8_one_section",
    f"""WITH {_CHUNKS}, {_PATH}, g AS (SELECT package_id, page, count(*) n, max_by(path, ord) path FROM pa WHERE page IS NOT NULL GROUP BY ALL),
x AS (SELECT * FROM (SELECT *, lead(page) OVER (PARTITION BY package_id ORDER BY page) - 1 AS last FROM g) WHERE n = 1),
k AS (SELECT DISTINCT id, package_id, page_first f, page_last l FROM c),
j AS (SELECT k.id, k.f, k.l, any_value(x.path) FILTER (k.f BETWEEN x.page AND coalesce(x.last, k.f)) a, any_value(x.path) FILTER (k.l BETWEEN x.page AND coalesce(x.last, k.l)) z FROM k LEFT JOIN x ON x.package_id = k.package_id AND (k.f BETWEEN x.page AND coalesce(x.last, k.f) OR k.l BETWEEN x.page AND coalesce(x.last, k.l)) GROUP BY ALL)
SELECT id, CASE WHEN f >= 1 AND coalesce(a, '') <> '' AND a = z THEN a END AS path, CASE WHEN f IS NULL THEN 'missing_page_range' WHEN f < 1 THEN 'invalid_page_range' WHEN coalesce(a, '') <> '' AND a = z THEN NULL ELSE 'section_not_unique' END AS error FROM j""",
)
def _(s, d):
    """The one section that holds the pages of a chunk, or why there is none."""
    r = toc.exclusive_ranges(toc.paths(views.toc_entries(s, d), ["package_id"]), ["package_id"])
    return identity.one_section(views.chunk_rows(s, d), r, ["package_id"], "id")


@query("e26_conflicts_by_member", f"WITH {_COLON_ROWS}, g AS (SELECT package_id, key, value, min(CAST(place AS VARCHAR)) f FROM k GROUP BY ALL), h AS (SELECT sha256(package_id || '|' || key || '|' || array_to_string(list_sort(list(value)), '|')) AS i, unnest(list(package_id || ':' || f)) AS member FROM g GROUP BY package_id, key HAVING count(*) > 1) SELECT member, string_agg(DISTINCT i, ';' ORDER BY i) AS conflict_ids FROM h GROUP BY member")
def _(s, d):
    """Conflicting lines with the conflicts that they stand in."""
    rows = anchors.colon_rows(views.markdown_lines(s, d), ["package_id"]).withColumn("m", F.concat("package_id", F.lit(":"), F.col("place").cast("string")))
    return identity.conflicts_by_member(records.conflicts(rows, ["package_id", "key"], "value", "m"))


@query("c18_cell_forms", r"SELECT item_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), ' ') AS form, regexp_replace(coalesce(text, ''), '\s+', '', 'g') = regexp_replace(coalesce(img_path, ''), '\s+', '', 'g') AS same FROM content_list")
def _(s, d):
    return table(s, d, "content_list").select("item_id", identity.cell_form("text").alias("form"), identity.cells_equal("text", "img_path").alias("same"))


@query("g11_pair_groups")
def _(s, d):
    """Two key/value candidates from each row of at least four cells."""
    r = grids.cells(_bodies(s, d), "item_id", "table_body", fill=True).groupBy("item_id", "table_no", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", "text"))).alias("x"))
    group = lambda k, v: F.struct(F.lit(k).alias("key_column"), F.array(F.struct(F.lit("value").alias("label"), F.lit(v).alias("column"))).alias("value_columns"), F.lit(None).cast("int").alias("marker_column"))
    got = r.select("item_id", "table_no", "row_no", F.explode(identity.pair_groups(F.transform("x", lambda c: c["text"]), F.array(group(0, 1), group(2, 3)))).alias("g"))
    return got.select("item_id", "table_no", F.concat_ws(".", "row_no", "g.slot").alias("row_index"), "g.key", "g.marker", "g.value")


@query("f9_first_column_parents")
def _(s, d):
    """Rows with their second cell as key, and as parent the first one where the first column repeats."""
    c = grids.cells(_bodies(s, d), "item_id", "table_body", fill=True)
    r = c.groupBy("item_id", "table_no", "row_no").agg(F.max(F.when(F.col("col_no") == 0, F.col("text"))).alias("first"), F.max(F.when(F.col("col_no") == 1, F.col("text"))).alias("key")).withColumn("key_column", F.lit(1)).withColumn("parent", F.lit(""))
    return identity.first_column_parents(r, ["item_id", "table_no"], "first", "key", "key_column", "parent").select("item_id", "table_no", "row_no", "key", "parent")


@query("i7_distinguished", "WITH q AS (SELECT toc_id, package_id || '@' || ord k, toc_page, sha256(coalesce(title, '') || '|' || coalesce(CAST(target_page AS VARCHAR), '')) h FROM toc_tree), g AS (SELECT k, count(*) n, count(DISTINCT h) c, bool_and(toc_page IS NOT NULL) a FROM q GROUP BY k) SELECT toc_id, CASE WHEN n > 1 AND c = n AND a THEN k || '-' || substr(h, 1, 16) ELSE k END AS entry FROM q JOIN g USING (k)")
def _(s, d):
    """Entries of one place in the table of contents told apart where they differ."""
    t = table(s, d, "toc_tree").withColumn("entry", F.concat("package_id", F.lit("@"), F.col("ord").cast("string")))
    return identity.distinguished(t, "entry", "toc_page", ["title", "target_page"]).select("toc_id", "entry")


@query("c22_builders", "SELECT item_id, '<!-- pages ' || (page_idx + 1) || '-' || (page_idx + 1) || ' -->' AS anchor, package_id || '_table_' || CASE WHEN page_idx IS NULL THEN 'unknown' ELSE 'p' || lpad(CAST(page_idx + 1 AS VARCHAR), CAST(greatest(4, len(CAST(page_idx + 1 AS VARCHAR))) AS INT), '0') END AS table_id FROM content_list")
def _(s, d):
    p = F.col("page_idx") + 1
    return table(s, d, "content_list").select("item_id", identity.page_anchor(p).alias("anchor"), identity.table_id("package_id", F.when(p.isNotNull(), F.array(p))).alias("table_id"))


@query("c23_page_lists", "SELECT id, list_sort(list_distinct(list_transform(string_split(p, ','), lambda x: CAST(trim(x) AS INT)))) AS pages FROM (SELECT DISTINCT id, replace(page, '-', ' , ') p FROM chunks WHERE regexp_matches(page, '^[1-9][0-9]{0,8}(-[1-9][0-9]{0,8})?$'))")
def _(s, d):
    c = table(s, d, "chunks").where(F.col("page").rlike(r"^[1-9][0-9]{0,8}(-[1-9][0-9]{0,8})?$")).select("id", F.replace("page", F.lit("-"), F.lit(" , ")).alias("p")).distinct()
    return c.select("id", identity.page_list("p").alias("pages"))
