"""Registered queries of the training-data operators (``opN_<name>``) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_substring_dedup")
def _op7(spark, sf_dir):
    from pricelake.llm.substring_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op8_suffix_dedup")
def _op8(spark, sf_dir):
    from pricelake.llm.suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op4_ngram_join")
def _op4(spark, sf_dir):
    from pricelake.llm.ngram_join import link_groups
    return link_groups(table(spark, sf_dir, "documents"))


def _lowered(column: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate(coalesce({column}, ''), '{upper}', '{upper.lower()}')"


_OP3_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all({_lowered('text')}, '{_OP3_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lowered('text')}, '{_OP3_WORDS}') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
       FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT rid, dw.k, i, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.phrase = bw.phrase),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


@query("op3_decontaminate", _OP3_SQL)
def _op3(spark, sf_dir):
    from pricelake.llm.decontaminate import contamination, report
    return report(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


_OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size,
             [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1]::DOUBLE AS weight,
             sum(source_size) OVER ()::DOUBLE AS total FROM s),
r(step, capped, rate) AS (
    SELECT 0, -1::BIGINT, (SELECT max(total) / sum(weight) FROM w)
    UNION ALL
    SELECT step + 1, n, CASE WHEN n = capped OR free IS NULL THEN NULL ELSE (total - fixed) / free END
    FROM (SELECT r.step, r.capped, r.rate, count(*) FILTER (3.0 * source_size < weight * rate) AS n,
                 coalesce(sum(3.0 * source_size) FILTER (3.0 * source_size < weight * rate), 0)::DOUBLE AS fixed,
                 sum(weight) FILTER (NOT 3.0 * source_size < weight * rate) AS free, max(total) AS total
          FROM r, w WHERE rate IS NOT NULL GROUP BY r.step, r.capped, r.rate)),
last AS (SELECT rate FROM r WHERE rate IS NOT NULL ORDER BY step DESC LIMIT 1),
t AS (SELECT source, source_size, least(3.0 * source_size, weight * rate)::DOUBLE AS target FROM w, last),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN epochs * size + greatest(0, least(size,
            floor(target)::BIGINT - epochs * source_size - start)) ELSE 0 END AS BIGINT) AS taken
FROM e
"""


@query("op6_mixing", _OP6_SQL)
def _op6(spark, sf_dir):
    from pricelake.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_language_id")
def _op5(spark, sf_dir):
    from pricelake.llm.langid import predictions
    return predictions(table(spark, sf_dir, "documents"))


@query("op9_embedding_dedup")
def _op9(spark, sf_dir):
    from pricelake.llm.embedding_lsh import near_groups
    return near_groups(table(spark, sf_dir, "embeddings"))


@query("op1_quality_classifier")
def _op1(spark, sf_dir):
    from pricelake.llm.cotrain import score
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Files of public tokenizers; a parameter, as their place differs from cluster to cluster.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's tokenizer splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@query("op2_token_counts")
def _op2(spark, sf_dir):
    from pricelake.llm.token_files import token_counts
    return token_counts(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


@query("op10_html_extraction")
def _op10(spark, sf_dir):
    from pricelake.llm.html_template import main_text
    return main_text(table(spark, sf_dir, "pages"))


_OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part,
             CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, fails),
e(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
      FROM e a, e b, e c, e d, e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
      AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, (SELECT bit FROM e WHERE letter = filter_order[step]) AS bit,
             coalesce((SELECT sum(bit) FROM e WHERE contains(filter_order[1:step - 1], letter)), 0)::INT AS before
      FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails & bit > 0 AND fails & before = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails & bit > 0 AND fails & before > 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails & bit > 0 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails & bit > 0 AND fails & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM m, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""


@query("op11_filter_audit", _OP11_SQL)
def _op11(spark, sf_dir):
    from pricelake.llm.filter_audit import audit
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_OP13_SQL = f"""
WITH p AS (SELECT lang, row_number() OVER () AS pid, w FROM (
               SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
               FROM (SELECT coalesce(lang, 'und') AS lang,
                            unnest(string_split_regex({_lowered('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents))
           WHERE len(w) > 0),
g AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a
      FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) r(k) WHERE len(w) >= k))
      GROUP BY lang, k, phrase HAVING count(*) >= 30),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
u AS (SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r, 2000000::HUGEINT * c.a // (x.a + y.a) AS score
      FROM (SELECT *, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)) c
      JOIN g x ON x.lang = c.lang AND x.phrase = head JOIN g y ON y.lang = c.lang AND y.phrase = tail),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(w[j:j + size - 1], ' ') AS phrase, max(a) AS longer
      FROM (SELECT *, unnest(range(1, k - size + 2)) AS j FROM (SELECT *, unnest(range(2, k)) AS size FROM c)) GROUP BY 1, 2),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, encode(b.phrase)) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * b.a)
SELECT o.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000
"""


@query("op13_collocations", _OP13_SQL)
def _op13(spark, sf_dir):
    from pricelake.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_vantage_points")
def _op12(spark, sf_dir):
    from pricelake.llm.vantage_points import nearest
    return nearest(table(spark, sf_dir, "embeddings"))
