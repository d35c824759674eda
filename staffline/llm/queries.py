"""Query keys of the subpackage: ``opN_<name>`` over the whole of its table,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffline.llm import (align, ann, balance, bm25, collocations, credentials, dart_minhash, langid, lbl, packing, pii,
                           spm_fst, wordpiece)
from staffline.llm.common import bound_batches, crc_remainder, read

#: Vocabulary file of a public tokenizer (SentencePiece model), read on the driver only.
PIECE_MODEL = os.environ.get("STAFFLINE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: JSON files of public tokenizers, read on the driver only.
WORD_TOKENIZER = os.environ.get("STAFFLINE_WORD_TOKENIZER", "/opt/tokenizers/word_bpe_49k.json")
BYTE_TOKENIZER = os.environ.get("STAFFLINE_BYTE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def query(key: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_batches(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = f"q_{key}", fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


@query("op1_nearest", oracle="""
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, e.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.v, e.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS score
  FROM e q JOIN e ON q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id AND len(q.v) = len(e.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    vectors = read(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query("op2_langid")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them by a
    linear-chain field over words."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False)))
    model = langid.train(langid.training_sample(docs.where(~F.col("held_out"))))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model)


@query("op3_pack")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 512 to 8192 tokens."""
    docs = read(spark, sf_dir, "documents")
    return packing.best_fit_pack(docs.select("doc_id", packing.token_length().alias("length")))


_ASSIGN_SQL = (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
               r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
_IDENT_SQL = (r"""(?:[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy]_?[Ii][Dd]|"""
              r"""[Aa][Cc][Cc][Oo][Uu][Nn][Tt]_?[Ii][Dd]|[Uu][Ss][Ee][Rr]_?[Nn][Aa][Mm][Ee])"""
              r"""["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9_.@-]{3,}""")

_ENDPOINT_SQL = r"""https?://[A-Za-z0-9][^\x09-\x0D\x20"''<>|]*"""


def _secret_kind_sql(no: int, pattern: str, ok: str, group: int = 0) -> str:
    return (f"SELECT rid, {no} AS kind, string_split_regex(t, '{pattern}') AS gaps, "
            f"list_transform(regexp_extract_all(t, '{pattern}', 0), lambda x: length(x)) AS sizes, "
            f"list_transform(regexp_extract_all(t, '{pattern}', {group}), lambda x: {ok}) AS oks "
            f"FROM d WHERE regexp_matches(t, '{pattern}')")


@query("op9_secrets", oracle=rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  {_secret_kind_sql(0, _ASSIGN_SQL, "length(x) >= 8", 1)}
  UNION ALL {_secret_kind_sql(1, "AKIA[A-Z0-9]+", "length(x) >= 16")}
  UNION ALL {_secret_kind_sql(2, "[0-9a-f]+", "length(x) >= 32")}
  UNION ALL {_secret_kind_sql(3, "[A-Za-z0-9+/_=-]{20,}",
                              "regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[a-z]')")}
  UNION ALL {_secret_kind_sql(4, _IDENT_SQL, "true")}
  UNION ALL {_secret_kind_sql(5, _ENDPOINT_SQL, "true")}),
u AS (
  SELECT rid, kind, unnest(range(1, len(sizes) + 1)) AS no,
         unnest(list_transform(gaps[:len(sizes)], lambda x: length(x))) AS gap, unnest(sizes) AS size,
         unnest(oks) AS ok FROM m),
s AS MATERIALIZED (
  SELECT rid, kind, ok, size, sum(gap + size) OVER (PARTITION BY rid, kind ORDER BY no) AS fin FROM u),
p AS MATERIALIZED (
  SELECT rid, kind, (fin - size)::BIGINT AS ini, fin::BIGINT AS fin FROM s WHERE ok),
w AS MATERIALIZED (
  SELECT * FROM p a WHERE kind >= 3 AND NOT EXISTS (
    SELECT 1 FROM p b WHERE b.rid = a.rid AND b.kind < 3 AND b.ini < a.fin AND a.ini < b.fin)),
has AS (
  SELECT w.*, EXISTS (SELECT 1 FROM p b WHERE b.rid = w.rid AND b.kind IN (1, 4)
                        AND b.ini < w.fin + {credentials.SCOPE} AND w.ini < b.fin + {credentials.SCOPE}) AS ident,
         EXISTS (SELECT 1 FROM p b WHERE b.rid = w.rid AND b.kind IN (0, 2, 3)
                   AND b.ini < w.fin + {credentials.SCOPE} AND w.ini < b.fin + {credentials.SCOPE}) AS secret
  FROM w),
f AS (
  SELECT rid, kind, ini, fin FROM p WHERE kind < 3
  UNION ALL SELECT rid, kind, ini, fin FROM has
  WHERE (kind = 3 AND ident) OR (kind = 4 AND secret) OR (kind = 5 AND ident AND secret)),
g AS (
  SELECT rid, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS c, count(*) FILTER (kind = 2) AS h,
         string_agg(['assign', 'access', 'hex', 'secret', 'ident', 'endpoint'][kind + 1] || ':' || ini || ':' || fin,
                    ',' ORDER BY ini, kind) AS spans,
         string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || ini || ':' || fin, ',' ORDER BY ini, kind)
           FILTER (kind < 3) AS base FROM f GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(c, 0)::BIGINT AS n_access,
       coalesce(h, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (rid)""")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, weak parts only where they complete a credential."""
    rows, spans = credentials.find_secrets(read(spark, sf_dir, "documents"))
    return credentials.span_report(rows, spans, credentials.KINDS, credentials.BASE)


@query("op5_pieces")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return spm_fst.encode_texts(read(spark, sf_dir, "documents"), spm_fst.load_model(PIECE_MODEL))


@query("op8_token_counts")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document, words of any length."""
    automaton = wordpiece.compile_pieces(wordpiece.read_pieces(PIECE_MODEL), max_chars=None)
    return wordpiece.count_tokens(read(spark, sf_dir, "documents"), automaton)


@query("op10_pii")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the base patterns, and what a
    semi-Markov field learned from them adds."""
    docs = read(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.train(pii.training_texts(docs)))


@query("op6_near_dups")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return dart_minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op4_lm_scores")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under a log-bilinear model learned
    from six sevenths of them, and under add-one unigrams."""
    docs = read(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(crc_remainder("doc_id", 7) == 2, F.lit(False)))
    return lbl.score_documents(docs, docs.where(~F.col("held_out")), keep=("held_out",))


@query("op7_search")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every document whose id is divisible by 20."""
    docs = read(spark, sf_dir, "documents")
    return bm25.search(docs, docs.where(F.col("doc_id") % 20 == 0), k=10)


@query("op13_balanced_pack")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenised, in sequences of 4,096 tokens of balanced cost."""
    docs = read(spark, sf_dir, "documents")
    return balance.pack_tokens(docs, read_text(WORD_TOKENIZER), end_id=2).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost")


@query("op11_align")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens and pieces of every document, aligned, with corpus-wide link counts."""
    docs = read(spark, sf_dir, "documents")
    return align.align_texts(docs, read_text(BYTE_TOKENIZER), read_bytes(PIECE_MODEL))


@query("op12_collocations", oracle=r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE k >= 2 AND a >= 100),
inside AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM c, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE inside.most IS NULL OR 100 * inside.most < 100 * c.a),
cut AS (
  SELECT lang, k, phrase, a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') AS tail
  FROM kept, (SELECT unnest(range(1, 5)) AS j) WHERE j < k),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, l.a AS l, r.a AS r, n.n, j,
         ((1000::HUGEINT * cut.a * n.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = head JOIN f r ON r.lang = cut.lang AND r.phrase = tail
  JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000""")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of 2 to 5 words of each language."""
    return collocations.mine(read(spark, sf_dir, "documents"))
