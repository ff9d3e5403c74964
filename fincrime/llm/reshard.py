"""Resharding by minimum-cost flow.

Documents lie in old shards (by a hash of the text, so that equal texts share
one).  Sizes of the old shards and capacities of the new ones make a transport
problem in which a byte that stays costs nothing and a byte that moves costs
one; its solution says how many bytes go from each old to each new shard.
Blocks of documents then fill these amounts, and only the files of shards that
lose or gain a block are written again; a shard that loses all goes.  ``op4``
writes the layout before to the shared folder, changes it there and returns what
it reads from the files.

Scale: Spark sums sizes by block; the driver sees one row a block, at most
``5 * old * BLOCKS + 4 * PART * new`` however large the input.  A block over a part
of a shard's bytes or rows is cut by the hash of the text, into parts of about a
mean block's size, so equal texts stay together; only a part that is still as
large (one hot group of copies, or the rows without a text) is cut by id.  The
table of blocks, under the same bound, is broadcast; slots are numbered in each block and shifted by the
block's offset, so that no task holds a shard.  Texts are read and written where
they are: they meet the table of blocks and are not shuffled.

Defined results: a null text has size 1, like an empty one; null ids and
repeated rows get places of their own; an empty table gives an empty one; an
item larger than a capacity makes its shard larger by that much; other columns
only go along into the files (the folders' column is named ``shard``, with
underscores behind it where the input has that name).
Between the commit of new files and the removal of emptied shards a reader can
see the documents of these twice.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from fincrime.llm.common import shared_path, table, whole, written

OLD, NEW = 12, 16
BLOCKS = 1024                # of an old shard
PART = 8                     # too large: over 1 / PART of a new shard


def least_moves(sizes: Sequence[int], room: Sequence[int]) -> list[list[int]]:
    """flow[i][j]: bytes from old shard i to new shard j, moving the fewest.

    Successive shortest paths over old shard -> new shard edges (cost 0 where
    i == j, else 1).  ``sum(room) >= sum(sizes)``."""
    n, m = len(sizes), len(room)
    flow = [[0] * m for _ in range(n)]
    supply, space = list(sizes), list(room)
    cost = lambda i, j: int(i != j)
    while any(supply):
        # distances from all old shards with bytes left, over the residual graph
        dist = {("o", i): 0 for i in range(n) if supply[i]}
        prev: dict = {}
        done = False
        while not done:                       # Bellman-Ford: edges back cost -1
            done = True
            for side, k in list(dist):
                for x in range(m if side == "o" else n):
                    if side == "o":
                        to, c = ("n", x), cost(k, x)
                    elif flow[x][k]:
                        to, c = ("o", x), -cost(x, k)
                    else:
                        continue
                    if dist[side, k] + c < dist.get(to, 1 << 60):
                        dist[to], prev[to], done = dist[side, k] + c, (side, k), False
        end = min((v for v in dist if v[0] == "n" and space[v[1]]), key=lambda v: (dist[v], v))
        path = [end]
        while path[-1] in prev:
            path.append(prev[path[-1]])
        path.reverse()
        amount = min(supply[path[0][1]], space[end[1]],
                     *[flow[b[1]][a[1]] for a, b in zip(path, path[1:]) if a[0] == "n"])
        for a, b in zip(path, path[1:]):
            if a[0] == "o":
                flow[a[1]][b[1]] += amount
            else:
                flow[b[1]][a[1]] -= amount
        supply[path[0][1]] -= amount
        space[end[1]] -= amount
    return flow


def fill(blocks: Sequence[tuple[int, int, int]], flow: Sequence[Sequence[int]]) -> dict[tuple[int, int], int]:
    """New shard of each block (old shard, key, bytes): largest first, each to
    the new shard whose amount from this old one has the most room left; what
    no amount can hold goes where the new shard as a whole lacks the most."""
    m = len(flow[0]) if flow else 0
    lack = [sum(f[j] for f in flow) for j in range(m)]
    left = [list(f) for f in flow]
    place, late = {}, []
    for old, key, size in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        j = max(range(m), key=lambda j: (left[old][j], -j))
        if left[old][j] >= size:
            left[old][j] -= size
            lack[j] -= size
            place[old, key] = j
        else:
            late.append((old, key, size))
    # lack as a heap: late blocks come largest first
    heap = [(-x, j) for j, x in enumerate(lack)]
    heapq.heapify(heap)
    for old, key, size in late:
        x, j = heapq.heappop(heap)
        place[old, key] = j
        heapq.heappush(heap, (x + size, j))
    return place


def old_shard(text: Column, old: int) -> Column:
    """The layout before: texts by hash."""
    return F.pmod(F.xxhash64(text), F.lit(old)).cast("int")


def _parts(df: DataFrame, big: DataFrame) -> DataFrame:
    """``df`` (old, block, g) with ``part`` of its block, by the text's hash ``g``; 0 in a block that is not cut."""
    part = F.pmod(F.xxhash64("g", F.lit(2)), F.col("parts")) + 1
    return df.join(F.broadcast(big), ["old", "block"], "left").withColumn("part", F.coalesce(part, F.lit(0))).drop("parts")


def keyed(df: DataFrame, big: DataFrame, hot: DataFrame, old: int) -> DataFrame:
    """``df`` (id, old, block, g) with ``key``, block or part of one or cut of a part, for ``block`` and ``g``."""
    most = old * BLOCKS + 1          # parts of a block and cuts of a part are fewer
    cut = F.pmod(F.xxhash64("id", F.lit(1)), F.col("cuts")) + 1
    return _parts(df, big).join(F.broadcast(hot), ["old", "block", "part"], "left") \
        .withColumn("key", (F.col("block") * most + F.col("part")) * most + F.coalesce(cut, F.lit(0))) \
        .drop("cuts", "part", "block", "g")


def _large(sums: DataFrame, old: int, new: int, total: int, rows: int, name: str) -> DataFrame:
    """``sums``' groups over a part of a shard, with how often to cut them: at most PART * new by
    bytes and as many by rows, as their shares sum to 1 each."""
    share = F.greatest(F.col("bytes") / F.lit(total or 1), F.col("n") / F.lit(rows or 1))
    return sums.filter(share * (PART * new) > 1).withColumn(name, F.ceil(share * (old * BLOCKS))).drop("bytes", "n")


def _plan(sizes: DataFrame, old: int, new: int) -> tuple[DataFrame, DataFrame, list[tuple[int, int, int, int]]]:
    """The tables of cut blocks and of cut parts, and a row (old, key, shard, offset) a block, part or cut."""
    added = [F.sum("size").alias("bytes"), F.count("*").alias("n")]
    sums = written(sizes.groupBy("old", "block").agg(*added), "reshard-blocks")
    total, rows = (x or 0 for x in sums.agg(F.sum("bytes"), F.sum("n")).first())
    big = _large(sums, old, new, total, rows, "parts")
    inside = _parts(sizes, big).filter("part > 0").groupBy("old", "block", "part").agg(*added)
    hot = written(_large(inside, old, new, total, rows, "cuts"), "reshard-hot")
    rows = keyed(sizes, big, hot, old).groupBy("old", "key").agg(*added).collect()
    room = [total // new + (j < total % new) for j in range(new)]
    of = [0] * old
    for r in rows:
        of[r["old"]] += r["bytes"]
    flow = least_moves(of, room)
    place = fill([(r["old"], r["key"], r["bytes"]) for r in rows], flow)
    table_, ends = [], [0] * new
    for r in sorted(rows, key=lambda r: (r["old"], r["key"])):
        j = place[r["old"], r["key"]]
        table_.append((r["old"], r["key"], j, ends[j]))
        ends[j] += r["n"]
    return big, hot, table_


PLACES = "old int, key long, shard int, offset long"


def plan(sizes: DataFrame, old: int, new: int) -> tuple[DataFrame, DataFrame]:
    """``sizes`` (id, size, old, block, and g, the hash of what stays together: without it a
    block does) with ``key``, and the table of (old, key) -> shard, offset."""
    if "g" not in sizes.columns:
        sizes = sizes.withColumn("g", F.col("block"))
    big, hot, places = _plan(sizes, old, new)
    return keyed(sizes, big, hot, old), sizes.sparkSession.createDataFrame(places, PLACES)


def _block(text: Column, old: int) -> Column:
    return F.pmod(F.floor(F.xxhash64(text) / F.lit(old)).cast("long"), F.lit(BLOCKS)).cast("long")


def measured(df: DataFrame, id: str, text: str, old: int, *more: Column) -> DataFrame:
    """id, size, crc, old, block and g (the text's hash) of each document."""
    t = whole(text)
    return df.select(
        *more,
        F.col(id).alias("id"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t).alias("crc"),
        old_shard(t, old).alias("old"), _block(t, old).alias("block"), F.xxhash64(t).alias("g"))


def reshard(df: DataFrame, id: str = "doc_id", text: str = "text", old: int = OLD, new: int = NEW) -> DataFrame:
    """One row a document: ``size``, ``text_crc32``, ``old_shard``, ``shard``, ``slot``, as planned."""
    s, places = plan(written(measured(df, id, text, old), "reshard-sizes"), old, new)
    # at most a row a block and part, see above
    return _slots(s.join(F.broadcast(places), ["old", "key"]), id)


def _slots(d: DataFrame, id: str) -> DataFrame:
    slot = F.col("offset") + F.row_number().over(Window.partitionBy("old", "key").orderBy("id", "crc")) - 1
    return d.select(F.col("id").alias(id), "size", F.col("crc").alias("text_crc32"), F.col("old").alias("old_shard"),
                    "shard", slot.cast("long").alias("slot"))


def folder(columns: Sequence[str]) -> str:
    """The name of the folders' column beside ``columns``."""
    name = "shard"
    while name.lower() in map(str.lower, columns):
        name += "_"
    return name


def _replace(d: DataFrame, moves: Iterable[tuple[int, int]], path: str, name: str) -> None:
    """Writes the rows of ``d`` in touched shards (column ``name``) as these shards'
    only files.  ``moves``: every (old shard, shard) that has rows.  An emptied shard
    has no rows to replace its folder, which is removed."""
    moves = set(moves)
    touched = {j for m in moves if m[0] != m[1] for j in m}
    if not touched:
        return
    d.filter(F.col(name).isin(sorted(touched))).write.partitionBy(name).mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").parquet(path)
    spark = d.sparkSession
    for j in sorted(touched - {shard for _, shard in moves}):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}={j}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def rewrite(df: DataFrame, placed: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> None:
    """Writes the files of the new shards that a block left or entered, under
    ``path/shard=<n>``; shards that keep all their documents are not touched.

    ``placed`` is ``reshard``'s result; ``id`` and the text's CRC name a row."""
    name = folder(df.columns)
    p = placed.select(F.col(id).alias("__id"), F.col("text_crc32").alias("__crc"), F.col("old_shard").alias("__old"),
                      F.col("shard").alias(name)).distinct()
    moves = [tuple(r) for r in p.select("__old", name).distinct().collect()]      # at most old * new
    d = df.withColumn("__own", F.crc32(whole(text)))
    d = d.join(p, d[id].eqNullSafe(p["__id"]) & (d["__own"] == p["__crc"]), "inner").drop("__id", "__crc", "__own", "__old")
    _replace(d, moves, path, name)


def files(spark, schema: StructType, path: str) -> DataFrame:
    """The documents of a layout, with the shard in whose folder they lie."""
    return spark.read.schema(StructType([*schema.fields, StructField(folder(schema.names), IntegerType())])).parquet(path)


def relaid(df: DataFrame, path: str, id: str = "doc_id", text: str = "text", old: int = OLD, new: int = NEW) -> DataFrame:
    """Writes ``df`` to ``path`` in the layout before, plans and rewrites there;
    ``reshard``'s columns, read from the files that are then in ``path``."""
    spark, name = df.sparkSession, folder(df.columns)
    df.withColumn(name, old_shard(whole(text), old)).write.partitionBy(name).parquet(path)
    before = files(spark, df.schema, path)
    big, hot, table_ = _plan(written(measured(before, id, text, old), "reshard-sizes"), old, new)
    places = spark.createDataFrame(table_, PLACES)
    moves = {(o, shard) for o, _, shard, _ in table_}
    lost = {o for o, shard in moves if o != shard}
    gained = {shard for o, shard in moves if o != shard}
    # the rows go along in a struct, so that no name of theirs meets the plan's
    rows = before.filter(F.col(name).isin(sorted(lost | gained))).select(
        F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(id).alias("id"), F.col(name).alias("old"),
        _block(whole(text), old).alias("block"), F.xxhash64(whole(text)).alias("g"))
    rows = keyed(rows, big, hot, old).join(F.broadcast(places), ["old", "key"]).select("row.*", F.col("shard").alias(name))
    _replace(rows, moves, path, name)
    # slots by the plan's offsets, all else as it lies in the files
    after = keyed(measured(files(spark, df.schema, path), id, text, old, F.col(name).alias("shard")), big, hot, old)
    return _slots(after.join(F.broadcast(places.drop("shard")), ["old", "key"]), id)


def op4(spark, sf_dir: str) -> DataFrame:
    return relaid(table(spark, sf_dir, "documents"), shared_path(spark, "reshard")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")
