"""Best-fit packing of texts into sequences of several permitted lengths.

Pieces are dealt into groups of bounded size; each group is packed by itself,
so that packing runs on all executors and a group's waste is at most one
partly filled bin per permitted length and pass. Within a group pieces go, longest first, into the open
bin that they fill best; a new bin takes the size of least cost for what is
still to come. The group is packed once for each permitted length as the largest
one opened, and the cheapest of these plans is kept; at last each bin is cut down
to the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffline.llm.common import cut_lineage

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length, in tokens.
OVERHEAD = 32
GROUP_PIECES = 20_000


def token_length(text_col: str = "text") -> Column:
    """Words and one end of text; NULL for a NULL text."""
    words = F.regexp_count(text_col, F.lit(r"\S+")).cast("long")
    return F.when(F.col(text_col).isNotNull(), words + 1)


def pack(lengths: Sequence[int], capacities: Sequence[int], overhead: int,
         opened: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Bin number of each length (given longest first), the offset in its bin,
    and the final capacity of each bin. ``opened``: sizes that may be opened
    beside the least one that holds the piece."""
    open_mask = 0                      # bit r: some open bin has r tokens free
    free: dict[int, list[int]] = {}    # tokens free -> bins
    size: list[int] = []
    used: list[int] = []
    at: list[int] = []
    offset: list[int] = []
    rest = sum(lengths)
    for n in lengths:
        fits = open_mask >> n
        if fits:
            gap = n + (fits & -fits).bit_length() - 1
            b = free[gap].pop()
            if not free[gap]:
                open_mask &= ~(1 << gap)
        else:
            least = next(c for c in capacities if c >= n)
            b = len(size)
            # Cost for each token that the bin can still hope to hold.
            size.append(min((c for c in capacities if c == least or (c in opened and c >= n)),
                            key=lambda c: ((c + overhead) / min(c, rest), c)))
            used.append(0)
            gap = size[b]
        at.append(b)
        offset.append(used[b])
        used[b] += n
        rest -= n
        if gap > n:
            free.setdefault(gap - n, []).append(b)
            open_mask |= 1 << (gap - n)
    return at, offset, [next(c for c in capacities if c >= u) for u in used]


def pack_jointly(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES,
                 overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """The cheapest of the plans that open bins up to each permitted length;
    ties go to the smaller length."""
    best = None
    for j in range(len(capacities)):
        plan = pack(lengths, capacities, overhead, capacities[:j + 1])
        cost = sum(plan[2]) + overhead * len(plan[2])
        if best is None or cost < best[0]:
            best = (cost, plan)
    return best[1]


def best_fit_pack(docs: DataFrame, length_col: str = "length", id_col: str = "doc_id",
                  capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD,
                  group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Place every token of every document in a sequence: doc_id, piece (from
    0), start, length, bin_id, capacity, bin_offset; one row per piece.

    A document longer than the longest permitted sequence is split into pieces
    of that length and a rest; nothing is cut away. Documents of NULL or no
    length get one row with piece 0, length 0 and NULL bin columns. Rows of one id
    are separate documents. An empty table gives no rows. Other columns are
    ignored.
    """
    caps = tuple(sorted(set(int(c) for c in capacities)))
    top = caps[-1]
    length = F.coalesce(F.greatest(F.col(length_col).cast("long"), F.lit(0)), F.lit(0))
    pieces = (docs.select(F.col(id_col).alias("doc_id"), length.alias("n"))
              .select("doc_id", "n", F.explode(F.sequence(
                  F.lit(0).cast("long"),
                  F.greatest(F.floor((F.col("n") - 1) / top), F.lit(0)))).alias("piece"))
              .select("doc_id", "piece", (F.col("piece") * top).alias("start"),
                      F.least(F.lit(top), F.col("n") - F.col("piece") * top).alias("length"),
                      F.monotonically_increasing_id().alias("row")))
    pieces = cut_lineage(pieces)
    full = pieces.where(F.col("length") > 0)
    groups = max(1, -(-full.count() // group_pieces))

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending")])
        at, offset, size = pack_jointly(table.column("length").to_pylist(), caps, overhead)
        bins = pa.array([(key[0].as_py() << 32) | b for b in at], pa.int64())
        return (table.select(["doc_id", "piece", "start", "length"]).append_column("bin_id", bins)
                .append_column("capacity", pa.array([size[b] for b in at], pa.int64()))
                .append_column("bin_offset", pa.array(offset, pa.int64())))

    kind = dict(pieces.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, piece long, start long, length long, bin_id long, capacity long, bin_offset long")
    placed = (full.withColumn("grp", F.pmod("row", F.lit(groups)))
              .groupBy("grp").applyInArrow(place, schema))
    none = F.lit(None).cast("long")
    return placed.unionByName(pieces.where(F.col("length") <= 0).select(
        "doc_id", "piece", "start", "length", none.alias("bin_id"), none.alias("capacity"),
        none.alias("bin_offset")))
