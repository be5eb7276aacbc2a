"""Assignment of documents to shards on a consistent-hash ring with bounded loads.

Every shard owns ``virtual_nodes`` places on a ring of 65,536 slots; a row starts at the
slot its id hashes to and belongs to the next place clockwise. A shard takes at most its
fair count of rows: ``rows // shards``, one more for the first ``rows % shards`` shards.
Rows that find their shard full go on clockwise to the next place whose shard has room, so
counts differ by one at most and a row moves no further than its neighbours' overflow
makes it.

The rows meet the ring in one aggregation (slot counts, 65,536 at most) and one window
over the slots. The walk itself runs on the counts, which do not grow with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLOTS = 1 << 16
ROW_BYTES = 16


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """Distinct (slot, shard) places in clockwise order; a taken slot passes a place on."""
    if shards * virtual_nodes > SLOTS // 2:
        raise ValueError("too many virtual nodes for the ring")
    owner: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            slot = _mix(shard * 0x1_0000 + node) % SLOTS
            while slot in owner:
                slot = (slot + 1) % SLOTS
            owner[slot] = shard
    return sorted(owner.items())


def _mix(value: int) -> int:
    """The finaliser of splitmix64."""
    mask = (1 << 64) - 1
    value = (value + 0x9E3779B97F4A7C15) & mask
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & mask
    value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) & mask
    return value ^ (value >> 31)


def walk(counts: dict[int, int], places: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (slot, first rank, end rank, shard, first place in the shard).

    Rows take their own place's shard while it has room, in clockwise order; then what is
    left walks on. Full places are skipped through a chain that is shortened as it is used.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(slot: int, rank: int, wanted: int, shard: int) -> int:
        taken = min(wanted, room[shard] - filled[shard])
        if taken:
            pieces.append((slot, rank, rank + taken, shard, filled[shard]))
            filled[shard] += taken
        return taken

    onward = list(range(len(places)))

    def open_place(index: int) -> int:
        seen = []
        while room[places[index][1]] == filled[places[index][1]]:
            seen.append(index)
            step = onward[index]
            index = step if step != index else (index + 1) % len(places)
        for i in seen:
            onward[i] = index
        return index

    left: list[tuple[int, int, int, int]] = []
    at = 0
    for slot in sorted(counts):
        while at < len(places) and places[at][0] < slot:
            at += 1
        home = at % len(places)
        taken = put(slot, 0, counts[slot], places[home][1])
        if taken < counts[slot]:
            left.append((slot, taken, counts[slot] - taken, home))
    for slot, rank, wanted, home in left:
        while wanted:
            home = open_place(home)
            taken = put(slot, rank, wanted, places[home][1])
            rank, wanted = rank + taken, wanted - taken
    return pieces


def shard(
    df: DataFrame,
    shards: int,
    virtual_nodes: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row.

    A null id hashes as a value of its own; a null text has no bytes. Rows that agree in
    all columns of the result but shard and slot are interchangeable. An empty input gives
    no rows. Other columns are not read.
    """
    data = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        _position(F.col(id_col)).alias("_slot"),
    )
    places = ring(shards, virtual_nodes)
    slot_counts = df.select(_position(F.col(id_col)).alias("s")).groupBy("s").count()
    counts = {r["s"]: r["count"] for r in slot_counts.collect()}  # at most SLOTS rows
    pieces = df.sparkSession.createDataFrame(
        walk(counts, places, shards), "_slot long, _from long, _to long, shard int, _base long"
    )
    ranked = rows.withColumn(
        "_rank",
        F.row_number().over(Window.partitionBy("_slot").orderBy(F.xxhash64("doc_id"), "doc_id", "text_crc32", "size"))
        - F.lit(1).cast("long"),
    )
    # SLOTS + shards pieces at most: a bound that does not depend on the input.
    joined = ranked.join(
        F.broadcast(pieces.withColumnRenamed("_slot", "_at")),
        (F.col("_slot") == F.col("_at")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    return joined.select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("_base") + F.col("_rank") - F.col("_from")).alias("slot"),
    )


def _position(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(SLOTS).cast("long"))
