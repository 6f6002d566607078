"""Resharding: the block transfers of a minimum-cost flow, then the affected files.

A layout is a folder of Parquet files by shard and file number. Rows belong to
*units*, the blocks that a transfer moves: hash cells of texts, so that equal
texts share a unit; a text that alone is larger than a unit (by bytes or by
rows) has units of its own, as many as it needs. What the driver sees is one
row per unit: their number follows ``UNITS`` and the bytes per file, never the
rows of a unit.

A new layout of n shards of near-equal bytes is planned in two steps. Heavy
texts are placed first, whole where they fit a shard. For the rest, old shard
sizes are supplies, what is left of the new shards' sizes are capacities, and
a minimum-cost flow (staying is free, a moved byte costs one) says how many
bytes go where; each old shard gives away its last cells. Only files that hold
a moved unit are rewritten; all others are read where they are.
"""

from __future__ import annotations

from collections import defaultdict, deque
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import new_run_dir
from .common import prepare, stored
from .graph import hinted

#: a text is heavy beyond this share (1/UNITS) of all bytes or rows; cells number as many at least
UNITS = 8192
#: bytes of text that a file should hold
FILE_BYTES = 512 << 20
#: files of a shard at least, so that a small move doesn't rewrite the whole shard
LEAST_FILES = 4
#: bytes that a row takes besides its text
ROW_BYTES = 8
#: shards may differ by this share of their mean (or by a row) before units are moved once more
TOLERANCE = 0.002


# --- the flow ---------------------------------------------------------------

class FlowNetwork:
    """Minimum-cost flow by successive shortest paths (costs may be any integers
    without a negative cycle)."""

    def __init__(self) -> None:
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.out: dict[int, list[int]] = defaultdict(list)

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        at = len(self.head)
        for tail, to, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[tail].append(len(self.head))
            self.head.append(to)
            self.room.append(r)
            self.cost.append(c)
        return at

    def flow_on(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def solve(self, source: int, sink: int) -> tuple[int, int]:
        """(amount, cost) of a cheapest flow of the largest amount."""
        amount = cost = 0
        while True:
            best, via, queue, queued = {source: 0}, {}, deque([source]), {source}
            while queue:
                a = queue.popleft()
                queued.discard(a)
                for e in self.out[a]:
                    b = self.head[e]
                    if self.room[e] > 0 and best[a] + self.cost[e] < best.get(b, 1 << 62):
                        best[b], via[b] = best[a] + self.cost[e], e
                        if b not in queued:
                            queued.add(b)
                            queue.append(b)
            if sink not in best:
                return amount, cost
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.head[via[at] ^ 1]
            push = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= push
                self.room[e ^ 1] += push
            amount += push
            cost += push * best[sink]


def transfers(old: list[int], new: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from old shard i to new shard j, fewest moved in all. ``old`` are
    sizes, ``new`` capacities with at least the same total; shard i stays in
    place where both have an i. A hub stands for all moves, so arcs grow with
    the shards and not with their pairs."""
    n, m = len(old), len(new)
    source, sink, hub = n + m, n + m + 1, n + m + 2
    net = FlowNetwork()
    for i, size in enumerate(old):
        net.arc(source, i, size, 0)
    stay = {i: net.arc(i, n + i, min(old[i], new[i]), 0) for i in range(min(n, m))}
    leave = [net.arc(i, hub, size, 1) for i, size in enumerate(old)]
    enter = [net.arc(hub, n + j, size, 0) for j, size in enumerate(new)]
    for j, size in enumerate(new):
        net.arc(n + j, sink, size, 0)
    amount, _ = net.solve(source, sink)
    if amount != sum(old):
        raise ValueError("the new shards are too small")
    out = {(i, i): net.flow_on(e) for i, e in stay.items() if net.flow_on(e)}
    given = [[j, net.flow_on(e)] for j, e in enumerate(enter) if net.flow_on(e)]
    for i, e in enumerate(leave):
        left = net.flow_on(e)
        while left:
            j, room = given[-1]
            part = min(left, room)
            out[i, j] = out.get((i, j), 0) + part
            left -= part
            given[-1][1] -= part
            if not given[-1][1]:
                given.pop()
    return out


# --- the plan ---------------------------------------------------------------

@dataclass
class Unit:
    unit: int
    shard: int                  # old shard
    file: int
    bytes: int
    rows: int
    heavy: int | None = None    # the heavy text that it belongs to
    target: int = -1            # new shard
    start: int = 0              # first slot in the new shard


@dataclass
class Shares:
    """Bytes of new shards, while units are placed."""
    load: list[int] = field(default_factory=list)

    def put(self, units: list[Unit], j: int) -> None:
        for u in units:
            u.target = j
            self.load[j] += u.bytes


def capacities(load: list[int], more: int) -> list[int]:
    """How many of ``more`` bytes each shard takes for loads as equal as can be."""
    order = sorted(range(len(load)), key=lambda j: load[j])
    filled, level, k = 0, load[order[0]], 1
    while k < len(order) and filled + (load[order[k]] - level) * k <= more:
        filled += (load[order[k]] - level) * k
        level = load[order[k]]
        k += 1
    each, rest = divmod(more - filled, k)
    out = [0] * len(load)
    for at, j in enumerate(order[:k]):
        out[j] = level - load[j] + each + (at < rest)
    return out


def fair_level(sizes: list[int], total: int, shards: int) -> float:
    """The size of an even shard, once rows that are larger than it have a
    shard of their own."""
    left = shards
    for size in sorted(sizes, reverse=True):
        if left == 1 or size * left <= total:
            break
        total -= size
        left -= 1
    return total / left


def place_heavy(groups: list[list[Unit]], shares: Shares, level: float) -> None:
    """Largest first: at home where there is room, else where there is most."""
    for units in sorted(groups, key=lambda g: (-sum(u.bytes for u in g), g[0].unit)):
        size, home = sum(u.bytes for u in units), units[0].shard
        roomy = min(range(len(shares.load)), key=lambda j: (shares.load[j], j))
        at_home = home < len(shares.load) and shares.load[home] + size <= level
        alone = home < len(shares.load) and size > level and shares.load[home] == 0
        shares.put(units, home if at_home or alone else roomy)


def even_out(items: list[list[Unit]], shares: Shares, level: float) -> None:
    """Move items from the fullest to the emptiest shard while shards differ by
    more than the tolerance and a move helps."""
    held = defaultdict(list)
    for units in items:
        held[units[0].target].append((sum(u.bytes for u in units), units[0].unit, units))
    for _ in range(4 * len(shares.load) + len(items)):
        full = max(range(len(shares.load)), key=lambda j: shares.load[j])
        bare = min(range(len(shares.load)), key=lambda j: shares.load[j])
        gap = shares.load[full] - shares.load[bare]
        fits = [x for x in held[full] if 0 < x[0] < gap]
        if gap <= max(TOLERANCE * level, 1) or not fits:
            return
        x = min(fits, key=lambda x: (abs(gap - 2 * x[0]), x[1]))
        held[full].remove(x)
        held[bare].append(x)
        shares.load[full] -= x[0]
        shares.put(x[2], bare)


def plan(units: list[Unit], old_shards: int, new_shards: int) -> list[Unit]:
    """Give every unit its new shard and its first slot there."""
    total = sum(u.bytes for u in units)
    level = fair_level([u.bytes for u in units if u.heavy is not None], total, new_shards)
    by_text = defaultdict(list)
    for u in sorted(units, key=lambda u: u.unit):
        if u.heavy is not None:
            by_text[u.heavy].append(u)
    # a text of more than a shard's size is dealt by its units
    heavy = [g for whole in by_text.values() for g in ([whole] if sum(u.bytes for u in whole) <= level else [[u] for u in whole])]
    shares = Shares([0] * new_shards)
    place_heavy(heavy, shares, level)
    light = [[u for u in units if u.heavy is None and u.shard == i] for i in range(old_shards)]
    sizes = [sum(u.bytes for u in of) for of in light]
    goes = transfers(sizes, capacities(shares.load, sum(sizes)))
    for i, of in enumerate(light):
        cuts = [(j, b) for (a, j), b in sorted(goes.items(), key=lambda x: (x[0][0] != x[0][1], x[0])) if a == i]
        at, k, end = 0, 0, cuts[0][1] if cuts else 0
        for u in sorted(of, key=lambda u: u.unit):
            while k + 1 < len(cuts) and 2 * at + u.bytes > 2 * end:
                k += 1
                end += cuts[k][1]
            shares.put([u], cuts[k][0] if cuts else min(i, new_shards - 1))
            at += u.bytes
    even_out(heavy + [[u] for of in light for u in of], shares, level)
    slots = [0] * new_shards
    for u in sorted(units, key=lambda u: u.unit):
        u.start = slots[u.target]
        slots[u.target] += u.rows
    return units


# --- files ------------------------------------------------------------------

PLAN = "unit long, old_shard int, file int, shard int, start long, rows long, bytes long, rewritten boolean"


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("bigint")


def lay_out(docs: DataFrame, root: str, shards: int, text_col: str = "text") -> list[Unit]:
    """Write ``docs`` as a layout of ``shards`` shards by hash of the text
    (version 0 under ``root``), and return its units."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    h, size = F.xxhash64(F.coalesce(text, F.lit(""))), size_of(text)
    narrow = stored(docs.select(h.alias("h"), size.alias("size")), "reshard-sizes")
    n, total = narrow.agg(F.count("*"), F.sum("size")).first()
    if not n:
        return []
    # at most 2 * UNITS texts exceed a share
    heavy = (narrow.groupBy("h").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
             .where((F.col("bytes") * UNITS > total) | (F.col("rows") * UNITS > n)).orderBy("h").collect())
    files = max(LEAST_FILES, -(-total // (shards * FILE_BYTES)))
    cells = files * max(1, -(-UNITS // (shards * files)))
    listed, first, owner = [], shards * cells, {}
    for r in heavy:
        parts = min(r["rows"], max(-(-r["bytes"] * UNITS // total), -(-r["rows"] * UNITS // n)))
        listed.append((r["h"], first, parts))
        owner |= {first + k: len(listed) - 1 for k in range(parts)}
        first += parts
    known = F.broadcast(spark.createDataFrame(listed, "h long, first long, parts long"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), h.alias("h"), size.alias("size"),
                       F.monotonically_increasing_id().alias("seq"))
    shard = F.pmod("h", F.lit(shards)).cast("int")
    cell = F.pmod(F.xxhash64("h"), F.lit(cells))
    placed = rows.join(known, "h", "left").select(
        "row", "size", "h", shard.alias("shard"),
        F.coalesce(F.col("first") + F.pmod(F.xxhash64("seq"), F.col("parts")), shard * F.lit(cells) + cell).cast("bigint").alias("unit"))
    file = F.when(F.col("unit") < shards * cells, F.expr(f"(unit % {cells}) div {cells // files}")).otherwise(files + F.col("unit") % files).cast("int")
    write(placed.withColumn("file", file), f"{root}/v0")
    sums = (spark.read.parquet(f"{root}/v0").groupBy("unit").agg(F.min("shard").alias("shard"), F.min("file").alias("file"),
                                                                 F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect())
    return [Unit(r["unit"], r["shard"], r["file"], r["bytes"], r["rows"], owner.get(r["unit"])) for r in sums]


def write(rows: DataFrame, path: str) -> None:
    """Rows by shard and file. Rebalancing splits what is too large for a task."""
    (rows.hint("rebalance", "shard", "file").write.option("compression", "zstd").partitionBy("shard", "file").parquet(path))


def rewrite(spark: SparkSession, root: str, units: list[Unit]) -> None:
    """Rewrite the files that hold a moved unit (version 1 under ``root``) and
    record the plan."""
    touched = {(u.shard, u.file) for u in units if u.target != u.shard}
    rows = [(u.unit, u.shard, u.file, u.target, u.start, u.rows, u.bytes, (u.shard, u.file) in touched) for u in units]
    spark.createDataFrame(rows, PLAN).write.parquet(f"{root}/plan")
    if touched:
        moved = spark.read.parquet(f"{root}/v0").where(in_files(touched)).drop("shard")
        write(moved.join(hinted(plan_of(spark, root).select("unit", "shard"), 64), "unit"), f"{root}/v1")


def plan_of(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(PLAN).parquet(f"{root}/plan")


def in_files(files: set[tuple[int, int]]) -> Column:
    """Rows of these files: a condition on the partition columns alone."""
    by_shard = defaultdict(list)
    for shard, file in sorted(files):
        by_shard[shard].append(file)
    out = F.lit(False)
    for shard, of in by_shard.items():
        out = out | ((F.col("shard") == shard) & F.col("file").isin(of))
    return out


def read_shards(spark: SparkSession, root: str) -> DataFrame:
    """The layout under ``root``: row (the input's columns), size, h, unit,
    shard. Files that the last resharding rewrote are read from version 1."""
    columns = ["row", "size", "h", "unit", F.col("shard").cast("int").alias("shard")]
    p = plan_of(spark, root)
    touched = {(r["old_shard"], r["file"]) for r in p.where("rewritten").select("old_shard", "file").distinct().collect()}
    old = spark.read.parquet(f"{root}/v0")
    if not touched:
        return old.select(*columns)
    new = spark.read.schema(old.schema).parquet(f"{root}/v1")
    return old.where(~in_files(touched)).select(*columns).unionByName(new.select(*columns))


def reshard(docs: DataFrame, shards: int, old_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
            root: str | None = None, columns: dict[str, Column] | None = None) -> DataFrame:
    """All rows of ``docs``, laid out as ``old_shards`` shards by hash of the
    text and then resharded to ``shards`` of near-equal bytes. The files stay
    under ``root`` (a new run folder if not given); the result is read from
    them: ``columns`` (expressions over ``row``, a struct of the input's
    columns; by default ``row`` itself), shard, slot (from 0, gapless per shard).

    A null text counts as an empty one. Equal texts, and repeated rows, share a
    shard unless they are more than a shard's share of all bytes (then they are
    dealt in units), or evenness asks for it; a row is never split, so a shard
    with a row above the mean is as large as that row. A null id is kept. An
    empty table gives an empty result; other columns are carried along under
    their names.
    """
    spark = prepare(docs.sparkSession)
    root = root or new_run_dir(spark, "shards")
    columns = columns or {"row": F.col("row")}
    units = lay_out(docs, root, old_shards, text_col)
    if not units:
        empty = docs.where(F.lit(False)).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        return empty.select(*[c.alias(name) for name, c in columns.items()], F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    rewrite(spark, root, plan(units, old_shards, shards))
    # a unit holds a bounded share of the rows, so numbering it is one task's work;
    # only the columns asked for move
    rows = read_shards(spark, root).select("unit", "shard", "h", F.col(f"row.`{id_col}`").alias("id"),
                                           F.struct(*[c.alias(name) for name, c in columns.items()]).alias("out"))
    place = F.row_number().over(Window.partitionBy("unit").orderBy("h", "id"))
    starts = hinted(plan_of(spark, root).select("unit", "start"), 64)
    return rows.withColumn("place", place).join(starts, "unit").select("out.*", "shard", (F.col("start") + F.col("place") - 1).alias("slot"))
