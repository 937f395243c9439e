"""Queries of the operators, with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import decontaminate as wm
from gondola.llm import (centroids, jaccard_join, line_dedup, lm_scoring, mixing, phrases, preference,
                         quality_rules, repair, token_counts, toxicity, warc)
from gondola.llm.frames import read
from gondola.session import fresh_path

TOKENIZER = "word_bpe_49k.json"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        _QUERIES[name] = build
        if sql:
            _SQL[name] = sql
        return build
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# words of a text as the decontamination contract splits them
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op1_decontaminate", f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) item_id, {_WORDS} w FROM benchmark
               WHERE text IS NOT NULL),
patterns AS (
  SELECT DISTINCT item_id, least(len(w), 10) m, array_to_string(w[i : i + 9], ' ') p
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) i
        FROM items WHERE len(w) > 0)),
texts AS (SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE {_WORDS} END w
          FROM documents),
lengths AS (SELECT DISTINCT m FROM patterns),
places AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') p
           FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) i FROM texts, lengths)),
found AS (SELECT doc_id, i, m, item_id FROM places JOIN patterns USING (m, p)),
hits AS (SELECT doc_id, count(DISTINCT k) n_hit
         FROM (SELECT doc_id, unnest(range(i, i + m)) k FROM found) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) n_items, string_agg(item_id, ',' ORDER BY item_id) ids
           FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit,
       coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256,
       coalesce(n_hit, 0) > 0 contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)""")
def op1_decontaminate(spark, sf_dir):
    return wm.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"),
                            keep=["doc_id"]).drop("item_ids", "hit_spans")


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op3_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, l.no, l.line,
         translate(trim(l.line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) x FROM documents) t,
       LATERAL (SELECT unnest(range(1, len(x) + 1)) no, unnest(x) line) l),
keeper AS (SELECT k, min(doc_id) first FROM lines WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT doc_id, no, line, coalesce(first <> doc_id, false) gone
           FROM lines LEFT JOIN keeper USING (k))
SELECT doc_id, count(*) n_lines, count(*) FILTER (gone) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) kept_sha256
FROM marked GROUP BY doc_id""")
def op3_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents")).drop("kept_text")


@query("op6_warc_revisit", """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) n, sha1(coalesce(html, '')) h FROM pages),
firsts AS (SELECT h, n, min(page_id) first FROM p GROUP BY h, n)
SELECT page_id, CAST(n AS BIGINT) payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(h, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))::INT)
          & 31) + 1, 1)), '') payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END record_type,
       CASE WHEN first <> page_id THEN first END refers_to
FROM p JOIN firsts USING (h, n)""")
def op6_warc_revisit(spark, sf_dir):
    path = fresh_path(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.resolve(warc.read_archives(spark, path))


@query("op8_token_ids")
def op8_token_ids(spark, sf_dir):
    path = fresh_path(spark, "token-ids")
    repair.write_shards(read(spark, sf_dir, "documents"), path, tokenizers.path(TOKENIZER))
    return repair.read_shards(spark, path)


@query("op9_jaccard_join", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
                              ELSE array_to_string(w[i : i + 2], ' ') END g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) i
            FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id a, y.doc_id b, count(*) k FROM s x JOIN s y USING (g) GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * k >= 90 * (na.n + nb.n - k)),
reach AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM links UNION
            SELECT r.a, l.b FROM r JOIN links l ON l.a = r.b) SELECT a, min(b) c FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) n_shingles, coalesce(least(c, w.doc_id), w.doc_id) component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id""")
def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))


def _held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), usable=~_held_out())
    return (toxicity.score(docs, model, keep=["doc_id"])
            .select("doc_id", _held_out().alias("held_out"), "score", "predicted"))


@query("op2_mix_sources")
def op2_mix_sources(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


_BINS = {"symbol_share": ("1000 * n_symbols // greatest(word_chars, 1)", "2"),
         "line_share": ("1000 * n_dup_lines // greatest(n_lines, 1)", "100"),
         "repeat_share": ("1000 * n_repeat_words // greatest(n_words, 1)", "60"),
         "word_size": ("least(8 * word_chars // greatest(n_words, 1), 8000)", "q2 // 8")}
_LEVELS = {"g": "lang, source", "l": "lang", "a": "1"}


def _levels() -> str:
    """Limits of every measure by (language, source), by language, and of all documents."""
    parts = []
    for level, keys in _LEVELS.items():
        names = {"g": "lang, source", "l": "lang, NULL AS source", "a": "NULL AS lang, NULL AS source"}
        parts.append(f"""
SELECT '{level}' lv, {names[level]}, m, n, q1 - 6 * s low, q3 + 6 * s high FROM (
 SELECT *, greatest(q3 - q1, 1, CASE m {" ".join(f"WHEN '{m}' THEN {v}" for m, (_, v) in _BINS.items())} END) s
 FROM (SELECT {keys.replace('1', "1 AS one")}, m, any_value(n) n, min(v) FILTER (4 * u >= n) q1,
   min(v) FILTER (4 * u >= 2 * n) q2, min(v) FILTER (4 * u >= 3 * n) q3
  FROM (SELECT *, count(*) OVER (PARTITION BY {keys}, m ORDER BY v) u,
          count(*) OVER (PARTITION BY {keys}, m) n FROM v)
  GROUP BY {keys.replace('1', 'one') if level != 'a' else 'one'}, m))""")
    return " UNION ALL ".join(parts)


@query("op4_quality_rules", rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') x,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) ls FROM documents),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) n
        FROM (SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') g
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM w))) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT k) n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) k FROM d)
      GROUP BY doc_id),
f AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) word_chars,
             CAST(len(regexp_extract_all(x, '[#*$%&|<>]')) AS BIGINT) n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) n_dup_lines, len(ls) n_lines,
             coalesce(n, 0) n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words base_failed FROM f),
c AS (SELECT doc_id, lang, source, base_failed, unnest([{", ".join(f"'{m}'" for m in _BINS)}]) m,
             unnest([{", ".join(e for e, _ in _BINS.values())}]) v FROM b),
v AS (SELECT * FROM c WHERE NOT base_failed),
lim AS ({_levels()}),
judged AS (SELECT c.doc_id, bool_and(CASE WHEN c.m = 'word_size' THEN v BETWEEN low AND high
                                     ELSE v <= high END) good
           FROM (SELECT c.doc_id, c.m, any_value(c.v) v, arg_min(low, p) low, arg_min(high, p) high
                 FROM c JOIN (SELECT *, CASE lv WHEN 'g' THEN 1 WHEN 'l' THEN 2 ELSE 3 END p
                              FROM lim) k ON k.m = c.m
                  AND ((lv = 'g' AND n >= 200 AND k.lang IS NOT DISTINCT FROM c.lang
                        AND k.source IS NOT DISTINCT FROM c.source)
                       OR (lv = 'l' AND n >= 200 AND k.lang IS NOT DISTINCT FROM c.lang)
                       OR lv = 'a') GROUP BY c.doc_id, c.m) c GROUP BY c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(good, false) kept FROM b LEFT JOIN judged USING (doc_id)""")
def op4_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"))


def _tails() -> str:
    """The SQL of op4_quality_rules with shares limited by their 99 % quantile, rule by rule."""
    sql = _SQL["op4_quality_rules"]
    for old, new in {
        "q3 + 6 * s high": "CASE m WHEN 'word_size' THEN q3 + 6 * s ELSE q99 END high",
        "min(v) FILTER (4 * u >= 3 * n) q3":
            "min(v) FILTER (4 * u >= 3 * n) q3, min(v) FILTER (100 * u >= 99 * n) q99",
        "judged AS (SELECT c.doc_id, ": "judged AS (SELECT c.doc_id, " + ", ".join(
            f"bool_or(c.m = '{m}' AND (v > high{' OR v < low' if m == 'word_size' else ''})) o_{m}"
            for m in _BINS) + ", ",
        "coalesce(good, false) kept": "coalesce(good, false) kept, " + ", ".join(
            f"NOT base_failed AND coalesce(o_{m}, false) over_{m}" for m in _BINS),
    }.items():
        assert old in sql
        sql = sql.replace(old, new)
    return sql


@query("op4_quality_tails", _tails())
def op4_quality_tails(spark, sf_dir):
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"), tail=99)


@query("op5_lm_scoring")
def op5_lm_scoring(spark, sf_dir):
    good = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_scoring.cross_entropy_difference(read(spark, sf_dir, "documents"), good)


@query("op10_preference_format", """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') r, text x, role,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) i
           FROM conversations),
a AS (SELECT conv_id, count(*) n, max(i) FILTER (role = 'assistant') last,
             list(i ORDER BY i) FILTER (role = 'assistant') pos FROM t GROUP BY conv_id),
c AS (SELECT conv_id, i, r, x FROM t JOIN a USING (conv_id) WHERE i <= coalesce(last, n)),
j AS (SELECT conv_id, i, r, x FROM t JOIN a USING (conv_id) WHERE i < last OR last IS NULL
      UNION ALL
      SELECT conv_id, last, r, x FROM t JOIN a USING (conv_id)
      WHERE len(pos) > 1 AND i = pos[len(pos) - 1]),
d AS (SELECT conv_id, i FROM c LEFT JOIN j USING (conv_id, i)
      WHERE j.i IS NULL OR c.r <> j.r OR c.x IS DISTINCT FROM j.x),
s AS (SELECT a.conv_id, coalesce(min(d.i) - 1, any_value(coalesce(last, n))) k
      FROM a LEFT JOIN d USING (conv_id) GROUP BY a.conv_id),
p AS (SELECT 'c' side, * FROM c UNION ALL SELECT 'j', * FROM j),
z AS (SELECT side, conv_id, i, k, r, '<|turn|>' || r || chr(10) || coalesce(x, '') || '<|end|>'
             || chr(10) v FROM p JOIN s USING (conv_id)),
m AS (SELECT *, length(v) n, sum(length(v)) OVER (PARTITION BY side, conv_id ORDER BY i) - length(v) b
      FROM z WHERE i > k)
SELECT s.conv_id, CAST(s.k AS BIGINT) n_shared,
  coalesce((SELECT string_agg(v, '' ORDER BY i) FROM z
            WHERE z.conv_id = s.conv_id AND side = 'c' AND i <= z.k), '') prompt,
  coalesce((SELECT string_agg(v, '' ORDER BY i) FROM m
            WHERE m.conv_id = s.conv_id AND side = 'c'), '') chosen,
  coalesce((SELECT string_agg(v, '' ORDER BY i) FROM m
            WHERE m.conv_id = s.conv_id AND side = 'j'), '') rejected,
  coalesce((SELECT string_agg((b + 9 + length(r)) || '+' || (n - 9 - length(r)), ',' ORDER BY i)
            FROM m WHERE m.conv_id = s.conv_id AND side = 'c' AND r = 'assistant'), '') chosen_mask,
  coalesce((SELECT string_agg((b + 9 + length(r)) || '+' || (n - 9 - length(r)), ',' ORDER BY i)
            FROM m WHERE m.conv_id = s.conv_id AND side = 'j' AND r = 'assistant'), '') rejected_mask
FROM s""")
def op10_preference_format(spark, sf_dir):
    convs = preference.conversations(read(spark, sf_dir, "conversations"))
    out = preference.format_pairs(preference.last_answer_pairs(convs))
    spans = lambda c: F.array_join(F.transform(c, lambda m: F.concat(
        m["start"].cast("string"), F.lit("+"), m["length"].cast("string"))), ",")
    return out.withColumns({c: spans(c) for c in ("chosen_mask", "rejected_mask")})


def _rounds(k: int, dims: int, rounds: int) -> str:
    """Assignment and new centroids of every round, then the last assignment."""
    near = """a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) v, min(d) d, arg_min(j, d * {k} + j) j
  FROM (SELECT vec_id, v, j, list_sum(list_transform(range(1, {m} + 1),
          lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT d FROM v, c{r}) GROUP BY vec_id)"""
    step = """,
c{s} AS MATERIALIZED (SELECT o.j, coalesce(z.c, o.c) c FROM c{r} o LEFT JOIN (
  SELECT j, list((t - (t % n + n) % n) // n ORDER BY i) c
  FROM (SELECT j, i, sum(x)::BIGINT t, count(*) n
        FROM (SELECT j, unnest(v) x, unnest(range({m})) i FROM a{r}) GROUP BY j, i)
  GROUP BY j) z USING (j)),
"""
    parts = []
    for r in range(rounds):
        parts += [near.format(r=r, k=k, m=dims), step.format(r=r, s=r + 1, m=dims)]
    return "".join(parts) + near.format(r=rounds, k=k, m=dims)


@query("op12_centroid_clustering", f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) v
  FROM embeddings WHERE len(embedding) = 64
   AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 j, v c
  FROM (SELECT sha256('1:' || vec_id) h, v FROM v ORDER BY h LIMIT 16)),
{_rounds(16, 64, 3)},
s AS (SELECT j, sum(d)::BIGINT t FROM a3 GROUP BY j)
SELECT vec_id, j::INT AS cluster, d AS distance, t cluster_inertia,
       (SELECT sum(t)::BIGINT FROM s) inertia, sha256(array_to_string(c, ',')) centroid_sha256
FROM a3 JOIN s USING (j) JOIN c3 USING (j)""")
def op12_centroid_clustering(spark, sf_dir):
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


@query("op11_phrase_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(
             coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') w FROM p),
g AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') ph, count(*) f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) i FROM w, (VALUES (1), (2), (3)) x(m))
  GROUP BY ALL),
c AS MATERIALIZED (SELECT lang, m, string_split(ph, ' ') w, ph, f a FROM g WHERE m > 1 AND f >= 10),
cuts AS (SELECT c.*, l.f l, r.f r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) score
         FROM (SELECT *, unnest(range(1, m)) k FROM c) c
         JOIN g l ON l.lang = c.lang AND l.ph = array_to_string(w[1 : k], ' ')
         JOIN g r ON r.lang = c.lang AND r.ph = array_to_string(w[k + 1 : c.m], ' ')),
best AS (SELECT * FROM cuts
         QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
covers AS (SELECT lang, ph, max(a) longer FROM (
  SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) ph, a
  FROM c WHERE m = 3) GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, ph) rank
           FROM best b LEFT JOIN covers USING (lang, ph)
           WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, ph phrase, a, l, r, n, score::BIGINT score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT n FROM g WHERE m = 1 GROUP BY lang) USING (lang)
WHERE rank <= 2000""")
def op11_phrase_collocations(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents"))


@query("op13_token_counts")
def op13_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"),
                                     tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
