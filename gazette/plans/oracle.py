"""DuckDB oracle SQL for the registered queries (views: the driver tables).

Each statement recomputes the query's answer with plain SQL over the same
parquet tables; column names and types are aliased to match the Spark side.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

NL = "chr(10)"
DOC_TITLE = f"split_part(text, {NL}, 1)"
EVENT_DIGEST = "strftime(ts, '%Y-%m-%d')"
SCHEME_RE = r"'^([A-Za-z][A-Za-z0-9+.\-]*):'"
AUTH_RE = r"'^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)'"


def _hit(k: str, cols=(DOC_TITLE, "text")) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({c}, '')), '{k}')" for c in cols) + ")"


def _any(kws, cols=(DOC_TITLE, "text")) -> str:
    return "(" + " OR ".join(_hit(k, cols) for k in kws) + ")" if kws else "FALSE"


def sql(name: str):
    def deco(fn):
        ORACLE[name] = fn()
        return fn

    return deco


from gazette.plans.catalog import (  # noqa: E402
    KW_MATCH_LIST,
    KW_NEGATIVE,
    KW_POSITIVE,
    KW_STAGE_NEG,
    KW_STAGE_POS,
)


@sql("kw_filter")
def _():
    return f"SELECT doc_id AS seq, source FROM documents WHERE {_any(KW_POSITIVE)}"


@sql("kw_filter_empty")
def _():
    return "SELECT doc_id AS seq, source FROM documents WHERE FALSE"


@sql("negative_kw_filter")
def _():
    return f"SELECT doc_id AS seq, source FROM documents WHERE NOT {_any(KW_NEGATIVE)}"


@sql("kw_matches")
def _():
    parts = ", ".join(f"CASE WHEN {_hit(k)} THEN '{k}' END" for k in KW_MATCH_LIST)
    return f"SELECT doc_id AS seq, concat_ws('|', {parts}) AS matched FROM documents"


@sql("filter_chain")
def _():
    return f"SELECT doc_id AS seq, source FROM documents WHERE NOT {_any(KW_STAGE_NEG)} AND {_any(KW_STAGE_POS)}"


@sql("stage_counts")
def _():
    neg, pos = _any(KW_STAGE_NEG), _any(KW_STAGE_POS)
    return f"""
    SELECT 'documents' AS digest_id, s.stage_ord, s.stage, s.n_rows FROM (
      SELECT 0::INTEGER AS stage_ord, 'input' AS stage, count(*)::BIGINT AS n_rows FROM documents
      UNION ALL SELECT 1::INTEGER, 'negative_keywords', count(*) FILTER (WHERE NOT {neg})::BIGINT FROM documents
      UNION ALL SELECT 2::INTEGER, 'keywords', count(*) FILTER (WHERE NOT {neg} AND {pos})::BIGINT FROM documents
    ) s"""


@sql("top_n")
def _():
    return f"""
    SELECT digest_id, seq, source, final_rank FROM (
      SELECT {EVENT_DIGEST} AS digest_id, event_id AS seq, event_type AS source,
             row_number() OVER (PARTITION BY {EVENT_DIGEST} ORDER BY event_id) AS final_rank
      FROM events) WHERE final_rank <= 10"""


@sql("dry_run")
def _():
    return f"""
    SELECT digest_id, seq, 'Summary not generated in dry run mode' AS generated_summary,
           'Insights not generated in dry run mode' AS why_care FROM (
      SELECT {EVENT_DIGEST} AS digest_id, event_id AS seq,
             row_number() OVER (PARTITION BY {EVENT_DIGEST} ORDER BY event_id) AS r FROM events) WHERE r <= 5"""


@sql("arrival_seq")
def _():
    return """
    WITH s AS (SELECT source, row_number() OVER (ORDER BY source) AS source_ord
               FROM (SELECT DISTINCT source FROM documents))
    SELECT d.doc_id, d.source, s.source_ord,
           row_number() OVER (ORDER BY s.source_ord, d.doc_id) AS seq
    FROM documents d JOIN s USING (source)"""


def _clean_url_sql(u: str) -> str:
    head = f"regexp_replace(regexp_extract({u}, '^([^?#]*)', 1), ';[^/]*$', '')"
    sch = f"regexp_extract({head}, {SCHEME_RE}, 1)"
    return f"CASE WHEN {sch} = '' THEN {head} ELSE lower({sch}) || substr({head}, length({sch}) + 1) END"


@sql("clean_urls")
def _():
    return f"SELECT page_id, {_clean_url_sql('url')} AS clean_url FROM pages"


@sql("domain_counts")
def _():
    return f"SELECT regexp_extract(url, {AUTH_RE}, 1) AS domain, count(*)::BIGINT AS n_pages FROM pages GROUP BY 1"


@sql("resolve_src")
def _():
    return f"""
    SELECT page_id, pos,
      CASE WHEN starts_with(h, 'data:') OR starts_with(h, 'http') THEN h ELSE base || h END AS resolved,
      CASE WHEN starts_with(h, 'data:') OR starts_with(h, 'http') THEN h
           WHEN starts_with(h, '//') THEN sch || ':' || h
           WHEN starts_with(h, '/') THEN base || h
           ELSE base || '/' || h END AS resolved_strict
    FROM (SELECT page_id, url, unnest(hs) AS h, generate_subscripts(hs, 1) - 1 AS pos, lower(regexp_extract(url, {SCHEME_RE}, 1)) AS sch,
                 lower(regexp_extract(url, {SCHEME_RE}, 1)) || '://' || regexp_extract(url, {AUTH_RE}, 1) AS base
          FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages))"""


@sql("content_key")
def _():
    return "SELECT doc_id AS seq, md5('doc://' || CAST(doc_id AS VARCHAR) || left(text, 100)) AS content_key FROM documents"


# ---------------------------------------------------------------- similarity
from gazette.plans.catalog import ASOF_SHIFT, HIST_BASE, LOOKBACK, SIM_T  # noqa: E402

EMB = "(SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
COS = "list_cosine_similarity"
HD = f"(DATE '{HIST_BASE}' + h.label)"
ASOF = f"(DATE '{HIST_BASE}' + c.label + {ASOF_SHIFT})"
IN_WINDOW = f"{HD} > {ASOF} - {LOOKBACK} AND {HD} <= {ASOF}"

# greedy scan in seq order carrying the leader list (exact reference semantics)
GREEDY = f"""
WITH RECURSIVE e AS {EMB},
nb AS (SELECT b.vec_id AS j, list(a.vec_id) AS lower FROM e a JOIN e b
       ON a.vec_id < b.vec_id AND {COS}(a.v, b.v) >= {SIM_T} GROUP BY b.vec_id),
ord AS (SELECT e.vec_id AS id, row_number() OVER (ORDER BY e.vec_id) AS k, coalesce(nb.lower, []) AS lower
        FROM e LEFT JOIN nb ON nb.j = e.vec_id),
walk(k, leaders) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT w.k + 1, CASE WHEN list_has_any(w.leaders, o.lower) THEN w.leaders ELSE list_append(w.leaders, o.id) END
  FROM walk w JOIN ord o ON o.k = w.k + 1),
leaders AS (SELECT unnest(leaders) AS id FROM walk WHERE k = (SELECT max(k) FROM ord)),
members AS (SELECT b.vec_id AS seq, min(a.vec_id) AS leader_seq, arg_min({COS}(a.v, b.v), a.vec_id) AS similarity
            FROM e a JOIN leaders l ON a.vec_id = l.id JOIN e b
            ON a.vec_id < b.vec_id AND {COS}(a.v, b.v) >= {SIM_T}
            WHERE b.vec_id NOT IN (SELECT id FROM leaders) GROUP BY b.vec_id),
groups AS (SELECT id AS seq, id AS leader_seq, NULL::DOUBLE AS similarity FROM leaders
           UNION ALL SELECT seq, leader_seq, similarity FROM members)
"""


@sql("cosine_pairs")
def _():
    return f"""SELECT a.vec_id AS i, b.vec_id AS j, round({COS}(a.v, b.v), 9) AS sim
    FROM {EMB} a JOIN {EMB} b ON a.vec_id < b.vec_id WHERE {COS}(a.v, b.v) >= {SIM_T}"""


@sql("novelty_filter")
def _():
    return f"""SELECT c.vec_id AS seq, CAST(c.label AS VARCHAR) AS source FROM {EMB} c
    WHERE NOT EXISTS (SELECT 1 FROM {EMB} h WHERE {IN_WINDOW} AND {COS}(c.v, h.v) >= {SIM_T})"""


@sql("novelty_scores")
def _():
    return f"""SELECT e.vec_id AS seq, max_sim, best_headline FROM embeddings e LEFT JOIN (
    SELECT seq, round(s, 9) AS max_sim, 'item ' || CAST(hid AS VARCHAR) AS best_headline FROM (
      SELECT c.vec_id AS seq, h.vec_id AS hid, {COS}(c.v, h.v) AS s,
             row_number() OVER (PARTITION BY c.vec_id ORDER BY {COS}(c.v, h.v) DESC, h.vec_id) AS r
      FROM {EMB} c JOIN {EMB} h ON {IN_WINDOW}) WHERE r = 1) b ON b.seq = e.vec_id"""


@sql("novelty_per_digest")
def _():
    return f"""SELECT CAST(c.vec_id % 2 AS VARCHAR) AS digest_id, c.vec_id AS seq FROM {EMB} c
    WHERE NOT EXISTS (SELECT 1 FROM {EMB} h WHERE h.vec_id % 2 = c.vec_id % 2 AND {IN_WINDOW} AND {COS}(c.v, h.v) >= {SIM_T})"""


@sql("history_window")
def _():
    return """
    WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
         lb AS (SELECT * FROM (VALUES (1), (7), (31)) t(lookback))
    SELECT strftime(a.d, '%Y-%m-%d') AS as_of, lb.lookback::INTEGER AS lookback, count(*)::BIGINT AS n_reports,
           'reading_list_' || strftime(min(h.d), '%Y%m%d') || '.md' AS first_file,
           'reading_list_' || strftime(max(h.d), '%Y%m%d') || '.md' AS last_file
    FROM d a CROSS JOIN lb JOIN d h ON h.d > a.d - lb.lookback AND h.d <= a.d
    GROUP BY a.d, lb.lookback"""


@sql("dedupe_leaders")
def _():
    return GREEDY + "SELECT id AS seq FROM leaders"


ORACLE["dedupe_leaders_partitioned"] = ORACLE["dedupe_leaders"]


@sql("dedupe_groups")
def _():
    return GREEDY + "SELECT seq, leader_seq, round(similarity, 9) AS similarity FROM groups"


@sql("related_lists")
def _():
    return GREEDY + """
    SELECT l.id AS seq, count(g.seq)::BIGINT AS n_related,
           coalesce(string_agg(CAST(g.seq AS VARCHAR), ',' ORDER BY g.seq), '') AS related_seqs
    FROM leaders l LEFT JOIN groups g ON g.leader_seq = l.id AND g.seq <> l.id GROUP BY l.id"""


# ---------------------------------------------------------------- ranking
# running per-row sums of cosines, one pick per recursion step
PEEL = """
WITH RECURSIVE
e AS (SELECT row_number() OVER (ORDER BY vec_id) AS p, vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
nn AS (SELECT count(*) AS n FROM e),
g AS (SELECT a.p, list(CASE WHEN a.p = b.p THEN 0.0 ELSE list_cosine_similarity(a.v, b.v) END ORDER BY b.p) AS r
      FROM e a, e b GROUP BY a.p),
gm AS (SELECT list(r ORDER BY p) AS m, list(list_sum(r) ORDER BY p) AS s0 FROM g),
walk(step, sc, k) AS (
  SELECT 0::BIGINT, (SELECT s0 FROM gm), NULL::BIGINT
  UNION ALL
  SELECT w.step + 1,
         list_transform(range(1, nn.n + 1),
                        lambda x: CASE WHEN x = pk.k OR w.sc[x] IS NULL THEN NULL ELSE w.sc[x] - gm.m[pk.k][x] END),
         pk.k
  FROM walk w, nn, gm,
       LATERAL (SELECT CASE WHEN nn.n - w.step <= 2
                     THEN list_position(list_transform(w.sc, lambda x: x IS NOT NULL), true)
                     ELSE list_position(list_transform(w.sc, lambda x: round(x / (nn.n - w.step - 1), 12)),
                                        list_max(list_transform(w.sc, lambda x: round(x / (nn.n - w.step - 1), 12)))) END AS k) pk
  WHERE w.step < nn.n)
SELECT e.id AS seq, w.step AS div_rank FROM walk w JOIN e ON e.p = w.k WHERE w.step >= 1
"""
ORACLE["peel_rank"] = PEEL
ORACLE["peel_rank_rounds"] = PEEL

MEAN_SIM = f"""
SELECT a.vec_id AS seq, avg({COS}(a.v, b.v)) AS m FROM {EMB} a JOIN {EMB} b ON a.vec_id <> b.vec_id GROUP BY a.vec_id"""


@sql("mean_similarity")
def _():
    return f"SELECT seq, round(m, 9) AS mean_sim FROM ({MEAN_SIM})"


@sql("static_centrality")
def _():
    return f"SELECT seq, row_number() OVER (ORDER BY round(m, 12) DESC, seq) AS div_rank FROM ({MEAN_SIM})"


# ---------------------------------------------------------------- balancing
from gazette.plans.catalog import BAL_N  # noqa: E402

BAL_M = max(BAL_N // 5, 3)


def _balance_sql(base: str, n: int = BAL_N) -> str:
    """The balancing loop over a list state per digest (``base``: d, id, src)."""
    return f"""
WITH RECURSIVE
b AS ({base}),
{_balance_ctes(n)}
SELECT d, unnest(ids) AS seq, unnest(srcs) AS src, unnest(range(1, len(ids) + 1)) AS final_rank FROM final"""


def _balance_ctes(n: int) -> str:
    m = max(n // 5, 3)
    return f"""init AS (SELECT d, list(id ORDER BY id) AS ids, list(src ORDER BY id) AS srcs FROM b GROUP BY d),
walk(d, it, ids, srcs, done) AS (
  SELECT d, 0, ids, srcs, false FROM init
  UNION ALL
  SELECT w.d, w.it + 1,
         CASE WHEN mv.k = 0 THEN w.ids ELSE pr.ids2 END,
         CASE WHEN mv.k = 0 THEN w.srcs ELSE pr.srcs2 END,
         mv.k = 0
  FROM walk w,
  LATERAL (SELECT list_slice(w.srcs, 1, {n}) AS t) tt,
  LATERAL (SELECT coalesce(list_position(list_transform(tt.t, lambda x: len(list_filter(tt.t, lambda y: y = x)) > {m}), true), 0) AS k) mv,
  LATERAL (SELECT list_concat(list_slice(w.ids, 1, mv.k - 1), list_slice(w.ids, mv.k + 1, len(w.ids)), [w.ids[mv.k]]) AS ids1,
                  list_concat(list_slice(w.srcs, 1, mv.k - 1), list_slice(w.srcs, mv.k + 1, len(w.srcs)), [w.srcs[mv.k]]) AS srcs1) m1,
  LATERAL (SELECT list_transform(range(1, len(m1.srcs1) + 1), lambda p:
                 CASE WHEN NOT list_contains(tt.t, m1.srcs1[p])
                       AND len(list_filter(m1.srcs1, lambda y: y = m1.srcs1[p])) > 1
                      THEN len(list_filter(m1.srcs1, lambda y: y = m1.srcs1[p])) * 1000000 - p END) AS sc) z,
  LATERAL (SELECT coalesce(list_position(z.sc, list_max(z.sc)), 0) AS pos) zp,
  LATERAL (SELECT CASE WHEN zp.pos > {n} THEN list_concat([m1.ids1[zp.pos]], list_slice(m1.ids1, 1, zp.pos - 1), list_slice(m1.ids1, zp.pos + 1, len(m1.ids1))) ELSE m1.ids1 END AS ids2,
                  CASE WHEN zp.pos > {n} THEN list_concat([m1.srcs1[zp.pos]], list_slice(m1.srcs1, 1, zp.pos - 1), list_slice(m1.srcs1, zp.pos + 1, len(m1.srcs1))) ELSE m1.srcs1 END AS srcs2) pr
  WHERE NOT w.done AND w.it < {n}),
final AS (SELECT * FROM walk QUALIFY it = max(it) OVER (PARTITION BY d))"""


@sql("balance_sources")
def _():
    base = f"SELECT {EVENT_DIGEST} AS d, event_id AS id, event_type AS src FROM events"
    return f"SELECT d AS digest_id, seq, final_rank FROM ({_balance_sql(base)})"


@sql("balance_sources_lang")
def _():
    base = "SELECT 'documents' AS d, doc_id AS id, lang AS src FROM documents"
    return f"SELECT seq, src AS source, final_rank FROM ({_balance_sql(base)})"


EV_TOP = f"""SELECT {EVENT_DIGEST} AS digest_id, event_id AS seq, event_type AS source,
             row_number() OVER (PARTITION BY {EVENT_DIGEST} ORDER BY event_id) AS r FROM events"""
SRC_STATS = f"""SELECT digest_id, source, count(*)::BIGINT AS n_rows, count(*) FILTER (WHERE r <= {BAL_N})::BIGINT AS n_top,
                min(seq) AS first_seq, min(r) AS fp, min(r) FILTER (WHERE r <= {BAL_N}) AS fpt
         FROM ({EV_TOP}) GROUP BY digest_id, source"""


@sql("source_counts")
def _():
    return f"SELECT digest_id, source, n_rows, n_top, first_seq FROM ({SRC_STATS})"


@sql("overrepresented")
def _():
    return f"SELECT digest_id, source, n_rows, n_top, first_seq FROM ({SRC_STATS}) WHERE n_top > {BAL_M}"


@sql("first_per_source")
def _():
    return f"SELECT {EVENT_DIGEST} AS digest_id, event_type AS source, min(event_id) AS first_seq FROM events GROUP BY ALL"


@sql("least_represented")
def _():
    return f"""
    WITH s AS ({SRC_STATS}),
    z AS (SELECT digest_id, source, row_number() OVER (PARTITION BY digest_id ORDER BY n_rows DESC, fp) AS k
          FROM s WHERE n_top = 0 AND n_rows > 1),
    t AS (SELECT digest_id, source, row_number() OVER (PARTITION BY digest_id ORDER BY n_top, fpt) AS k
          FROM s WHERE n_top > 0)
    SELECT t.digest_id, coalesce(z.source, t.source) AS source,
           CASE WHEN z.source IS NOT NULL THEN 'absent' ELSE 'fewest' END AS rule
    FROM t LEFT JOIN z ON z.digest_id = t.digest_id AND z.k = 1 WHERE t.k = 1"""


# ---------------------------------------------------------------- rendering
from gazette.plans.catalog import HISTORY_ASOF, REPORT_N  # noqa: E402

WS = r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
HRE = f"'^(#{{1,6}}){WS}+(.+)$'"
HEADED = f"""(SELECT doc_id, {DOC_TITLE} AS title, source, text,
  CASE doc_id % 8
    WHEN 0 THEN '# ' || {DOC_TITLE} || chr(10) || text
    WHEN 1 THEN '## ' || {DOC_TITLE} || chr(10) || text
    WHEN 2 THEN '# ' || {DOC_TITLE} || chr(10) || '## ' || source || chr(10) || text
    WHEN 3 THEN '### ' || {DOC_TITLE} || chr(10) || '#### ' || source || chr(10) || '##### a' || chr(10) || '###### b' || chr(10) || text
    WHEN 4 THEN text
    WHEN 5 THEN '#x ' || {DOC_TITLE} || chr(10) || text
    WHEN 6 THEN '####### ' || {DOC_TITLE} || chr(10) || text
    ELSE '#   ' || {DOC_TITLE} || chr(10) || '##' || chr(9) || source || chr(10) || text END AS headed
  FROM documents)"""


def _normalize_sql(col: str) -> str:
    lv = f"length(regexp_extract(l, {HRE}, 1))"
    body = f"regexp_extract(l, {HRE}, 2)"
    levels = f"list_transform(string_split({col}, chr(10)), lambda l: {lv})"
    shift = f"(list_contains({levels}, 1) AND list_contains({levels}, 2))"
    return f"""array_to_string(list_transform(string_split({col}, chr(10)), lambda l:
        CASE WHEN {lv} = 0 THEN l
             WHEN {lv} = 1 THEN '### ' || {body}
             WHEN {lv} = 2 AND {shift} THEN '#### ' || {body}
             ELSE repeat('#', least(4, {lv} + 1)) || ' ' || {body} END), chr(10))"""


@sql("normalize_headers")
def _():
    return f"SELECT doc_id AS seq, md5({_normalize_sql('headed')}) AS normalized_md5 FROM {HEADED}"


@sql("article_blocks")
def _():
    nl2 = "chr(10) || chr(10)"
    return f"""
    WITH h AS {HEADED},
    lead AS (SELECT title, min(doc_id) AS lead FROM h GROUP BY title),
    rel AS (SELECT l.lead, string_agg('- [' || h.title || '](doc://' || CAST(h.doc_id AS VARCHAR) || ')' || chr(10), '' ORDER BY h.doc_id) AS lines
            FROM h JOIN lead l ON h.title = l.title AND h.doc_id > l.lead GROUP BY l.lead)
    SELECT h.doc_id AS seq, md5(
        '## ' || coalesce(h.title, 'None') || {nl2}
        || '*Source: ' || coalesce(h.source, 'None') || '*' || {nl2}
        || CASE WHEN h.headed IS NOT NULL AND length(h.headed) > 0 THEN {_normalize_sql('h.headed')} || {nl2} ELSE '' END
        || '[Read more](doc://' || CAST(h.doc_id AS VARCHAR) || ')' || {nl2}
        || CASE WHEN r.lines IS NOT NULL THEN '### Related Articles' || {nl2} || r.lines || chr(10) ELSE '' END
        || '---' || {nl2}) AS block_md5
    FROM h JOIN lead l ON h.doc_id = l.lead LEFT JOIN rel r ON r.lead = h.doc_id"""


EV_REPORT = f"""
    SELECT digest_id, '# Daily Reading List - ' || digest_id || chr(10) || chr(10) || string_agg(
        '## ' || title || chr(10) || chr(10) || '*Source: ' || source || '*' || chr(10) || chr(10)
        || 'Summary not generated in dry run mode' || chr(10) || chr(10)
        || '### Why Should I Care?' || chr(10) || chr(10) || 'Insights not generated in dry run mode' || chr(10) || chr(10)
        || '[Read more](event://' || CAST(seq AS VARCHAR) || ')' || chr(10) || chr(10) || '---' || chr(10) || chr(10),
        '' ORDER BY r) AS markdown
    FROM (SELECT {EVENT_DIGEST} AS digest_id, event_id AS seq, event_type AS source,
                 event_type || ' ' || CAST(event_id AS VARCHAR) AS title,
                 row_number() OVER (PARTITION BY {EVENT_DIGEST} ORDER BY event_id) AS r FROM events)
    WHERE r <= {REPORT_N} GROUP BY digest_id"""


@sql("reports")
def _():
    return f"SELECT digest_id, md5(markdown) AS report_md5, length(markdown)::BIGINT AS n_chars FROM ({EV_REPORT})"


@sql("headings")
def _():
    return f"""SELECT digest_id, (generate_subscripts(h, 1) - 1)::BIGINT AS pos, unnest(h) AS headline
    FROM (SELECT digest_id, regexp_extract_all(markdown, '(?m)^## (.+)$', 1) AS h FROM ({EV_REPORT}))"""


@sql("history_headlines")
def _():
    return f"""SELECT digest_id AS digest_date, title AS headline FROM (
      SELECT {EVENT_DIGEST} AS digest_id, event_type || ' ' || CAST(event_id AS VARCHAR) AS title,
             row_number() OVER (PARTITION BY {EVENT_DIGEST} ORDER BY event_id) AS r FROM events)
    WHERE r <= {REPORT_N} AND CAST(digest_id AS DATE) > DATE '{HISTORY_ASOF}' - {LOOKBACK}
      AND CAST(digest_id AS DATE) <= DATE '{HISTORY_ASOF}'"""


@sql("history_per_digest")
def _():
    return f"""SELECT reader AS digest_id, day AS digest_date, CAST(r - 1 AS BIGINT) AS pos, title AS headline FROM (
      SELECT {EVENT_DIGEST} AS day, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS reader,
             event_type || ' ' || CAST(event_id AS VARCHAR) AS title,
             row_number() OVER (PARTITION BY {EVENT_DIGEST}, event_id % 2 ORDER BY event_id) AS r FROM events)
    WHERE r <= {REPORT_N} AND CAST(day AS DATE) > DATE '{HISTORY_ASOF}' - {LOOKBACK} AND CAST(day AS DATE) <= DATE '{HISTORY_ASOF}'"""


@sql("records_json")
def _():
    return f"""SELECT {EVENT_DIGEST} AS digest_id, event_id AS seq, CAST(json_object(
      'title', event_type || ' ' || CAST(event_id AS VARCHAR), 'link', 'event://' || CAST(event_id AS VARCHAR),
      'published', strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'summary', coalesce(CAST(props AS VARCHAR), ''), 'source', event_type,
      'comments_link', NULL, 'generated_summary', 'Summary not generated in dry run mode',
      'why_care', 'Insights not generated in dry run mode') AS VARCHAR) AS record FROM events"""


# ---------------------------------------------------------------- pages / enrichment
from gazette.plans.catalog import PROMPT_TEMPLATE  # noqa: E402

TRIM = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
# well-formed pages: the article's text nodes are the pieces between tags
PAGE_TEXT = f"""(SELECT page_id, url, html, array_to_string(list_filter(list_transform(
      regexp_split_to_array(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>'),
      lambda s: trim(replace(replace(s, '&quot;', '"'), '&amp;', '&'), {TRIM})), lambda s: s <> ''), chr(10)) AS text
    FROM pages)"""
PAGE_ART = f"""(SELECT page_id AS seq, url AS link, html,
      replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&quot;', '"'), '&amp;', '&') AS title,
      regexp_extract(url, {AUTH_RE}, 1) AS source,
      'conv://' || CAST(page_id AS VARCHAR) AS comments_link FROM pages)"""
COMMENTS = f"""(SELECT 'conv://' || CAST(conv_id AS VARCHAR) AS comments_link,
      CASE WHEN one IS NULL THEN NULL WHEN conv_id % 5 < 2 THEN one || chr(10) || chr(10) || each WHEN conv_id % 5 < 4 THEN one ELSE each || chr(10) || chr(10) || one END AS comments
    FROM (SELECT conv_id, string_agg(t, ' ' ORDER BY turn) FILTER (WHERE t <> '') AS one, string_agg(t, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE t <> '') AS each
      FROM (SELECT conv_id, turn, trim(text, {TRIM}) AS t FROM conversations) GROUP BY conv_id))"""
CONTENT = f"""(SELECT a.seq, a.link, a.title, a.source, a.comments_link,
      CASE WHEN p.text IS NOT NULL AND length(p.text) > 0 AND c.comments IS NOT NULL AND length(c.comments) > 0
           THEN p.text || chr(10) || chr(10) || 'COMMENTS:' || chr(10) || c.comments ELSE p.text END AS content
    FROM {PAGE_ART} a LEFT JOIN {PAGE_TEXT} p ON p.url = a.link LEFT JOIN {COMMENTS} c ON c.comments_link = a.comments_link)"""
LEADERS = f"""(SELECT c.*, l.lead FROM {CONTENT} c JOIN (SELECT title, min(seq) AS lead FROM {PAGE_ART} GROUP BY title) l
               ON c.title = l.title)"""
BUNDLE = f"""(SELECT m.seq, m.link, m.title, m.source,
      count(r.seq)::BIGINT AS n_related,
      'Main Article from ' || m.link || ':' || chr(10) || coalesce(m.content, 'None') || chr(10) || chr(10) ||
      coalesce(string_agg('Related Article from ' || r.link || ':' || chr(10) || coalesce(r.content, 'None'), chr(10) ORDER BY r.seq), '') AS bundle
    FROM {LEADERS} m LEFT JOIN {LEADERS} r ON r.lead = m.seq AND r.seq > m.seq
    WHERE m.seq = m.lead GROUP BY m.seq, m.link, m.title, m.source, m.content)"""


@sql("page_text")
def _():
    return f"SELECT page_id, text FROM {PAGE_TEXT}"


# what the pages are decorated with, by their number (catalog.decorated_pages)
NUMBER = "CAST(page_id AS VARCHAR)"
TECH = "CASE WHEN page_id % 7 = 0 THEN page_id // 7 % 4 END"
CLEAN_TEXT = f"""CASE WHEN page_id % 7 <> 0 THEN array_to_string(list_filter(list_transform(string_split(text, chr(10)),
      lambda l: trim(l, {TRIM})), lambda l: l <> ''), chr(10)) ELSE CASE {TECH} WHEN 2 THEN 'words ' || {NUMBER} WHEN 3 THEN 'tech ' || {NUMBER} END END"""
SITE = f"lower(regexp_extract(url, {SCHEME_RE}, 1)) || '://' || regexp_extract(url, {AUTH_RE}, 1)"
PAGE_IMAGE = f"""CASE page_id % 6 WHEN 0 THEN '/og/' || {NUMBER} || '.png' WHEN 1 THEN 'https://t.example/' || {NUMBER} || '.png'
      WHEN 2 THEN CASE WHEN page_id % 7 = 0 THEN 'https://techcrunch.com' ELSE {SITE} END || '/logo/x.png'
      ELSE CASE {TECH} WHEN 1 THEN 'https://techcrunch.com/t/' || {NUMBER} || '.png' WHEN 2 THEN 'https://techcrunch.com/author/' || {NUMBER} || '.png' END END"""
RULE_IMAGE = f"""CASE WHEN page_id % 7 = 0 THEN CASE {TECH} WHEN 1 THEN '/t/' || {NUMBER} || '.png' WHEN 2 THEN '/wp-content/' || {NUMBER} || '.png' END
      ELSE CASE page_id % 6 WHEN 0 THEN '/og/' || {NUMBER} || '.png' WHEN 1 THEN '' WHEN 2 THEN '/pic/' || {NUMBER} || '.png' END END"""


@sql("page_text_clean")
def _():
    return f"SELECT page_id, {CLEAN_TEXT} AS text FROM {PAGE_TEXT}"


@sql("page_image")
def _():
    return f"SELECT page_id, {PAGE_IMAGE} AS image_url, {RULE_IMAGE} AS image_rules FROM pages"


@sql("page_stats")
def _():
    added = f"""CASE page_id % 6 WHEN 3 THEN 'buy' || chr(10) || 'this' WHEN 4 THEN 'menu here' || chr(10) || 'small print' END,
      CASE {TECH} WHEN 2 THEN 'words ' || {NUMBER} WHEN 3 THEN 'tech ' || {NUMBER} || chr(10) || 'no' END"""
    return f"""SELECT page_id, replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&quot;', '"'), '&amp;', '&') AS title,
      CAST(length(concat_ws(chr(10), {added}, text)) AS BIGINT) AS text_chars, CAST(length({CLEAN_TEXT}) AS BIGINT) AS clean_chars,
      {PAGE_IMAGE} AS image_url, {RULE_IMAGE} AS image_rules, page_id % 5 = 0 AS has_comments FROM {PAGE_TEXT}"""


@sql("page_comments")
def _():
    return f"SELECT comments_link, comments FROM {COMMENTS}"


@sql("page_lookup")
def _():
    return f"""
    SELECT 'pages' AS digest_id, l.lead AS seq, TRUE AS has_page FROM (SELECT title, min(seq) AS lead FROM {PAGE_ART} GROUP BY title) l
    UNION ALL
    SELECT 'documents', doc_id, ('doc://' || CAST(doc_id AS VARCHAR)) IN (SELECT url FROM pages) FROM documents"""


@sql("content_with_comments")
def _():
    return f"SELECT seq, md5(content) AS content_md5, length(content)::BIGINT AS n_chars FROM {CONTENT}"


@sql("content_bundle")
def _():
    return f"SELECT seq, n_related, md5(bundle) AS bundle_md5 FROM {BUNDLE}"


@sql("image_choice")
def _():
    image = f"(SELECT page_id, {PAGE_IMAGE} AS image FROM pages)"
    return f"""SELECT m.seq, coalesce(any_value(mi.image), min_by(ri.image, r.seq)) AS image_url
    FROM {PAGE_ART} m JOIN (SELECT title, min(seq) AS lead FROM {PAGE_ART} GROUP BY title) l ON m.seq = l.lead JOIN {image} mi ON mi.page_id = m.seq
    LEFT JOIN {PAGE_ART} r ON r.title = m.title AND r.seq > m.seq LEFT JOIN {image} ri ON ri.page_id = r.seq GROUP BY m.seq"""


def _prompt_sql() -> str:
    parts = []
    import re as _re

    pos = 0
    for m in _re.finditer(r"\{(\w+)\}", PROMPT_TEMPLATE):
        if m.start() > pos:
            parts.append("'" + PROMPT_TEMPLATE[pos : m.start()].replace("'", "''").replace("\n", "' || chr(10) || '") + "'")
        col = {"title": "title", "source": "source", "link": "link", "summary": "''",
               "content": "CASE WHEN bundle IS NOT NULL AND length(bundle) > 0 THEN bundle ELSE '' END"}[m.group(1)]
        parts.append(f"coalesce({col}, 'None')")
        pos = m.end()
    if pos < len(PROMPT_TEMPLATE):
        parts.append("'" + PROMPT_TEMPLATE[pos:].replace("'", "''").replace("\n", "' || chr(10) || '") + "'")
    return " || ".join(parts)


@sql("prompts")
def _():
    return f"SELECT seq, md5({_prompt_sql()}) AS prompt_md5 FROM {BUNDLE}"


@sql("responses")
def _():
    return f"""
    SELECT a.seq, md5(coalesce(r.text, 'Error generating summary')) AS summary_md5,
           CASE WHEN r.text IS NULL THEN 'Error generating insights' ELSE '' END AS why_care
    FROM {PAGE_ART} a LEFT JOIN (SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn, text) AS text
                                 FROM conversations WHERE role = 'assistant' GROUP BY conv_id) r
      ON r.conv_id = a.seq"""


# ---------------------------------------------------------------- feeds
from gazette.plans.catalog import FEED_ITEMS  # noqa: E402


@sql("feed_scan")
def _():
    return f"""
    WITH d AS (SELECT doc_id, source, text, doc_id // {FEED_ITEMS} AS blk,
                      row_number() OVER (PARTITION BY source, doc_id // {FEED_ITEMS} ORDER BY doc_id) - 1 AS entry_ord
               FROM documents),
    f AS (SELECT source, blk, row_number() OVER (ORDER BY source, blk) AS source_ord FROM (SELECT DISTINCT source, blk FROM d))
    SELECT (f.source_ord * 4294967296 + d.entry_ord)::BIGINT AS seq,
           trim({DOC_TITLE.replace('text', 'd.text')}) AS title,
           'doc://' || CAST(d.doc_id AS VARCHAR) AS link,
           TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (d.doc_id) MINUTE AS published,
           md5(trim(d.text, chr(32) || chr(9) || chr(10) || chr(13))) AS summary_md5,
           d.source, 'conv://' || CAST(d.doc_id AS VARCHAR) AS comments_link
    FROM d JOIN f ON f.source = d.source AND f.blk = d.blk
    LEFT JOIN labels l ON l.doc_id = d.doc_id
    WHERE coalesce(l.quality, 1) <> 0"""


# ---------------------------------------------------------------- exact bag-of-words cosine
from gazette.plans.catalog import BOW_T  # noqa: E402


@sql("bow_similarity")
def _():
    return f"""
    WITH t AS (SELECT doc_id, tok FROM (
                 SELECT doc_id, unnest(regexp_split_to_array(lower({DOC_TITLE}), '[^\\p{{L}}\\p{{N}}]+')) AS tok FROM documents)
               WHERE tok <> ''),
    c AS (SELECT doc_id, tok, count(*)::DOUBLE AS c FROM t GROUP BY doc_id, tok),
    n AS (SELECT doc_id, sqrt(sum(c * c)) AS nrm FROM c GROUP BY doc_id),
    p AS (SELECT a.doc_id AS i, b.doc_id AS j, sum(a.c * b.c) AS dot FROM c a JOIN c b
          ON a.tok = b.tok AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id)
    SELECT i, j, round(dot / (na.nrm * nb.nrm), 9) AS sim FROM p
    JOIN n na ON na.doc_id = i JOIN n nb ON nb.doc_id = j
    WHERE dot / (na.nrm * nb.nrm) >= {BOW_T}"""


@sql("feed_isolation")
def _():
    return f"""SELECT d.source || '/' || CAST(d.doc_id // {FEED_ITEMS} AS VARCHAR) AS feed, count(*)::BIGINT AS n_entries
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1 HAVING min(coalesce(l.quality, 1)) <> 0"""


# ---------------------------------------------------------------- default encoder, all stages
from gazette.plans.catalog import ENCODER_DIM  # noqa: E402


@sql("title_embedding")
def _():
    return f"""
    WITH t AS (SELECT doc_id, unnest(regexp_split_to_array(lower({DOC_TITLE}), '[^\\p{{L}}\\p{{N}}_]+')) AS tok FROM documents),
    p AS (SELECT doc_id, CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % {ENCODER_DIM} AS place, count(*) AS c FROM t WHERE tok <> '' GROUP BY ALL)
    SELECT doc_id AS seq, place, round(c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)), 9) AS weight FROM p"""


@sql("digest_stage_counts")
def _():
    kept = f"""(SELECT c.* FROM {EMB} c WHERE NOT contains('item ' || CAST(c.vec_id AS VARCHAR), 'item 1')
      AND NOT EXISTS (SELECT 1 FROM {EMB} h WHERE {IN_WINDOW} AND {COS}(c.v, h.v) >= {SIM_T}))"""
    greedy = GREEDY.replace(f"e AS {EMB}", f"e AS {kept}")
    named = "NOT contains('item ' || CAST(vec_id AS VARCHAR), 'item 1')"
    return greedy + f"""
    SELECT 'embeddings' AS digest_id, CAST(stage_ord AS INTEGER) AS stage_ord, stage, CAST(n_rows AS BIGINT) AS n_rows FROM (
      SELECT 0 AS stage_ord, 'input' AS stage, count(*) AS n_rows FROM embeddings
      UNION ALL SELECT 1, 'negative_keywords', count(*) FILTER (WHERE {named}) FROM embeddings
      UNION ALL SELECT 2, 'keywords', count(*) FILTER (WHERE {named}) FROM embeddings
      UNION ALL SELECT 3, 'novelty', count(*) FROM e
      UNION ALL SELECT 4, 'grouping', count(*) FROM leaders
      UNION ALL SELECT 5, 'limit', least(count(*), {BAL_N}) FROM leaders)"""


# ---------------------------------------------------------------- the whole run
from gazette.plans.flagship import AS_OF, FLAGSHIP  # noqa: E402


@sql("daily_digest")
def _():
    """Every step of the run, one digest per language, on sparse title vectors."""
    cfg, dim, nl = FLAGSHIP, 256, "chr(10)"
    nl2 = f"{nl} || {nl}"
    places = (
        lambda rows: f"""(SELECT id, place, c, sqrt(sum(c * c) OVER (PARTITION BY id)) AS nrm FROM (
      SELECT id, CAST('0x' || substr(md5(tok), 1, 8) AS BIGINT) % {dim} AS place, CAST(count(*) AS DOUBLE) AS c FROM (
        SELECT id, unnest(regexp_split_to_array(lower(title), '[^\\p{{L}}\\p{{N}}_]+')) AS tok FROM {rows}) WHERE tok <> '' GROUP BY ALL))"""
    )
    balance = _balance_ctes(cfg.max_articles).replace("walk", "bwalk").replace("final AS", "bfinal AS")
    return f"""
WITH RECURSIVE
a AS (SELECT doc_id AS id, lang AS d, source, {DOC_TITLE} AS title FROM documents WHERE NOT {_any(cfg.negative_keywords)} AND {_any(cfg.keywords)}),
h AS (SELECT item_id AS id, {DOC_TITLE} AS title FROM benchmark),
pa0 AS {places("a")}, ph AS {places("h")},
seen AS (SELECT DISTINCT x.id FROM pa0 x JOIN ph y USING (place) GROUP BY x.id, y.id
         HAVING round(sum(x.c * y.c) / any_value(x.nrm * y.nrm), 12) >= {cfg.novelty_similarity_threshold}),
kept AS (SELECT * FROM a WHERE id IN (SELECT id FROM pa0) AND id NOT IN (SELECT id FROM seen)),
pa AS (SELECT p.*, k.d FROM pa0 p JOIN kept k USING (id)),
sim AS (SELECT x.d, x.id AS i, y.id AS j, sum(x.c * y.c) / any_value(x.nrm * y.nrm) AS s FROM pa x JOIN pa y ON x.d = y.d AND x.place = y.place AND x.id <> y.id GROUP BY ALL),
nb AS (SELECT j, list(i) AS lower FROM sim WHERE i < j AND round(s, 12) >= {cfg.similarity_threshold} GROUP BY j),
ord AS (SELECT id, row_number() OVER (ORDER BY id) AS k, coalesce(nb.lower, []) AS lower FROM kept LEFT JOIN nb ON nb.j = id),
gwalk(k, leaders) AS (
  SELECT 0::BIGINT, []::BIGINT[]
  UNION ALL
  SELECT w.k + 1, CASE WHEN list_has_any(w.leaders, o.lower) THEN w.leaders ELSE list_append(w.leaders, o.id) END FROM gwalk w JOIN ord o ON o.k = w.k + 1),
lead AS (SELECT unnest(leaders) AS id FROM gwalk WHERE k = (SELECT max(k) FROM ord)),
member AS (SELECT j AS id, min(i) AS leader FROM sim WHERE i < j AND round(s, 12) >= {cfg.similarity_threshold} AND i IN (SELECT id FROM lead) AND j NOT IN (SELECT id FROM lead) GROUP BY j),
e AS (SELECT kept.id, d, source, row_number() OVER (PARTITION BY d ORDER BY kept.id) AS p, count(*) OVER (PARTITION BY d) AS n FROM kept JOIN lead USING (id)),
cell AS (SELECT x.d, x.p AS p, y.p AS q, coalesce(s.s, 0.0) AS s FROM e x JOIN e y ON x.d = y.d LEFT JOIN sim s ON s.i = x.id AND s.j = y.id),
g AS (SELECT d, p, list(s ORDER BY q) AS r FROM cell GROUP BY d, p),
gm AS (SELECT d, list(r ORDER BY p) AS m, list(list_sum(r) ORDER BY p) AS s0, count(*) AS n FROM g GROUP BY d),
pwalk(d, step, sc, k) AS (
  SELECT d, 0::BIGINT, s0, NULL::BIGINT FROM gm
  UNION ALL
  SELECT w.d, w.step + 1, list_transform(range(1, gm.n + 1), lambda x: CASE WHEN x = pk.k OR w.sc[x] IS NULL THEN NULL ELSE w.sc[x] - gm.m[pk.k][x] END), pk.k
  FROM pwalk w JOIN gm ON gm.d = w.d,
  LATERAL (SELECT CASE WHEN gm.n - w.step <= 2 THEN list_position(list_transform(w.sc, lambda x: x IS NOT NULL), true)
    ELSE list_position(list_transform(w.sc, lambda x: round(x / (gm.n - w.step - 1), 12)),
                       list_max(list_transform(w.sc, lambda x: round(x / (gm.n - w.step - 1), 12)))) END AS k) pk
  WHERE w.step < gm.n),
ranked AS (SELECT w.d, w.step AS r, e.id, e.source FROM pwalk w JOIN e ON e.d = w.d AND e.p = w.k WHERE w.step >= 1),
b AS (SELECT d, r AS id, source AS src FROM ranked),
{balance},
top AS (SELECT x.d, x.final_rank, r.id FROM (SELECT d, unnest(ids) AS r, unnest(range(1, len(ids) + 1)) AS final_rank FROM bfinal) x
        JOIN ranked r ON r.d = x.d AND r.r = x.r WHERE x.final_rank <= {cfg.max_articles}),
rel AS (SELECT m.leader AS id, string_agg('- [' || a.title || '](doc://' || CAST(a.id AS VARCHAR) || ')' || {nl}, '' ORDER BY a.id) AS lines FROM member m JOIN a ON a.id = m.id GROUP BY 1),
report AS (SELECT t.d AS digest_id, '# Daily Reading List - {AS_OF}' || {nl2} || string_agg(
    '## ' || a.title || {nl2} || '*Source: ' || a.source || '*' || {nl2}
    || 'Summary not generated in dry run mode' || {nl2} || '### Why Should I Care?' || {nl2} || 'Insights not generated in dry run mode' || {nl2}
    || '[Read more](doc://' || CAST(a.id AS VARCHAR) || ')' || {nl2}
    || coalesce('### Related Articles' || {nl2} || rel.lines || {nl}, '') || '---' || {nl2}, '' ORDER BY t.final_rank) AS markdown
  FROM top t JOIN a ON a.id = t.id LEFT JOIN rel ON rel.id = t.id GROUP BY t.d)
SELECT digest_id, md5(markdown) AS report_md5, CAST(length(markdown) AS BIGINT) AS n_chars FROM report"""
