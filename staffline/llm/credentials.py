"""Secrets in texts, with multipart credentials linked by an interval join.

Native Spark only. One pass over the texts keeps, per document, what the
patterns matched and the lengths of the text between; everything after that
works on these short lists. Strong finds (``assign``, ``access``, ``hex``) are
reported as they are. Weak parts (``secret``: a long mixed token, ``ident``: a
named account, ``endpoint``: a service address) are reported only if
complementary parts lie within ``scope`` code points in the same document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffline.llm.common import cut_lineage

# The patterns of the base kinds, in the order of the report.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# A run of fewer than 32 is dropped anyway, so only runs of 32 or more are matched.
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

# Weak parts. A long token counts as a secret only if it mixes digits, capitals and small letters.
SECRET = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
IDENT = (r"""(?i:client_?id|access_?key_?id|account_?id|user_?name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""")
ENDPOINT = r"""https?://[A-Za-z0-9][^\x09-\x0D\x20"'<>|]*"""

KINDS = ("assign", "access", "hex", "secret", "ident", "endpoint")
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX,
            "secret": SECRET, "ident": IDENT, "endpoint": ENDPOINT}
#: So many of the kinds are base kinds.
BASE = 3
SCOPE = 256


def _passes(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(match) >= 8  # its group 2 is what stands here
    if kind == "access":
        return F.length(match) >= 16
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    return F.lit(True)


def _cuts(text: Column, kind: str) -> Column:
    """For each match an element (code points since the last match, length of
    the match, whether it passes); NULL without a match."""
    pattern = PATTERNS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kind == "assign" else whole
    zipped = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)),
        F.zip_with(whole, value, lambda w, v: F.struct(F.length(w).alias("size"), _passes(kind, v).alias("ok"))),
        lambda g, m: F.struct(F.length(g).alias("gap"), m["size"].alias("size"), m["ok"].alias("ok")))
    return F.when(text.rlike(pattern), zipped)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): a frame (row, doc_id) of all documents, and a frame
    (row, kind, start, end) of all spans found, offsets in code points, end
    exclusive; ``kind`` is an index of ``KINDS``.

    NULL text counts as empty. Rows that repeat an id are separate documents, told apart by ``row``
    (fixed once in the checkpoint). Other columns are ignored. Very long texts are
    read in one regular-expression pass per pattern; spans of one document are
    summed by a window, not gathered.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = cut_lineage(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"))
        .select("row", "doc_id", *(_cuts(F.col("text"), k).alias(k) for k in KINDS)))
    cuts = None
    for i, kind in enumerate(KINDS):
        part = (found.where(F.col(kind).isNotNull())
                .select("row", F.lit(i).alias("kind"), F.posexplode(kind).alias("at", "cut"))
                .select("row", "kind", "at", "cut.gap", "cut.size", "cut.ok"))
        cuts = part if cuts is None else cuts.unionByName(part)
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    spans = (cuts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
             .withColumn("start", F.col("end") - F.col("size"))
             .where("ok").select("row", "kind", "start", "end"))
    spans = cut_lineage(spans)
    strong = spans.where(F.col("kind") < BASE)
    weak = _apart(spans.where(F.col("kind") >= BASE), strong, scope)
    secret = spans.where(F.col("kind").isin(0, 2, 3))
    ident = spans.where(F.col("kind").isin(1, 4))
    # A weak secret needs an identifier, an identifier a secret, an endpoint both.
    linked = (_near(weak.where(F.col("kind") == 3), ident, scope)
              .unionByName(_near(weak.where(F.col("kind") == 4), secret, scope))
              .unionByName(_near(_near(weak.where(F.col("kind") == 5), ident, scope), secret, scope)))
    return found.select("row", "doc_id"), strong.unionByName(linked)


def _buckets(low: Column, high: Column, scope: int) -> Column:
    return F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Rows of ``left`` with a row of ``right`` of the same document less than
    ``scope`` code points away: an equi-join on buckets, the distance as a rest."""
    a = left.withColumn("b", _buckets(F.col("start") - scope, F.col("end") + scope, scope))
    b = (right.select(F.col("row").alias("r_row"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
         .withColumn("r_b", _buckets(F.col("r_start"), F.col("r_end"), scope)))
    hit = ((F.col("row") == F.col("r_row")) & (F.col("b") == F.col("r_b"))
           & (F.col("r_start") < F.col("end") + scope) & (F.col("start") < F.col("r_end") + scope))
    return a.join(b, hit, "left_semi").select("row", "kind", "start", "end").distinct()


def _apart(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Rows of ``left`` that overlap no row of ``right``."""
    a = left.withColumn("b", _buckets(F.col("start"), F.col("end") - 1, scope))
    b = (right.select(F.col("row").alias("r_row"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
         .withColumn("r_b", _buckets(F.col("r_start"), F.col("r_end") - 1, scope)))
    over = a.join(b, (F.col("row") == F.col("r_row")) & (F.col("b") == F.col("r_b"))
                  & (F.col("r_start") < F.col("end")) & (F.col("start") < F.col("r_end")), "left_semi")
    return left.join(over.select("row", "kind", "start", "end").distinct(), ["row", "kind", "start", "end"],
                     "left_anti")


def span_report(rows: DataFrame, spans: DataFrame, kinds: tuple[str, ...], base: int) -> DataFrame:
    """One row per document: doc_id, n_<kind> of the base kinds, base_sha256
    and spans (``kind:start:end`` by start, then kind, comma-joined)."""
    name = F.element_at(F.array(*(F.lit(k) for k in kinds)), F.col("kind") + 1)
    item = F.struct("start", "kind", F.concat_ws(":", name, F.col("start").cast("string"),
                                                 F.col("end").cast("string")).alias("s"))
    per = spans.groupBy("row").agg(
        *(F.sum((F.col("kind") == i).cast("long")).alias(f"n_{kinds[i]}") for i in range(base)),
        F.array_sort(F.collect_list(F.when(F.col("kind") < base, item))).alias("b"),
        F.array_sort(F.collect_list(item)).alias("a"))

    def joined(col: str) -> Column:
        return F.coalesce(F.array_join(F.transform(F.col(col), lambda x: x["s"]), ","), F.lit(""))

    return rows.join(per, "row", "left").select(
        "doc_id", *(F.coalesce(F.col(f"n_{kinds[i]}"), F.lit(0).cast("long")).alias(f"n_{kinds[i]}")
                    for i in range(base)),
        F.sha2(joined("b"), 256).alias("base_sha256"), joined("a").alias("spans"))
