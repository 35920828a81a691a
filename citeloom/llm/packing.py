"""Problem 8: filling containers of fixed capacity with whole documents, in a controlled mixture of sources.

Documents are dealt to shards of about equal size by a hash. In each shard a deficit round-robin over one queue per source fills
container after container: the source that is furthest behind its target share of tokens gives its largest document that
still fits; when it has none that fits, the next source is asked, and a container is closed when nothing fits. Deficits are
carried from container to container, and from shard to shard: how much more or less of each source the earlier shards hold than its
part of all tokens is known from prefix sums, so that all shards are filled at the same time. (A source that ran out before its target
was met has no claim on the next shard.) A document longer than the capacity gives pieces that fill whole containers, and a rest. ``mixture`` measures how far runs of containers are from the target.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tokens that a shard holds for each token of capacity. More give fuller containers, fewer give more parallel tasks.
SHARD_CONTAINERS = 512
#: Shards whose sums are added up in one task; prefix sums go over such ranges first, so no task orders all shards.
RANGE = 256
#: Windows that one run may have.
MOST_WINDOWS = 1_000
_OUT = pa.schema(
    [
        ("window_name", pa.string()), ("capacity_tokens", pa.int32()), ("shard", pa.int32()), ("container", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("source", pa.string()), ("start_token", pa.int64()), ("tokens", pa.int64()),
    ]
)


def fill(items: list[tuple[str, int, int, int]], capacity: int, share: dict[str, float], deficit: dict[str, float]) -> list[list[tuple[str, int, int, int]]]:
    """Containers of items (source, size, id, piece), none larger than ``capacity``; ``deficit`` is carried on in place.

    Within a queue the largest item that fits comes first, ties by id. A source's deficit grows by its share of the tokens
    packed and shrinks by what it gives, so shares are met over the run of containers."""
    queues: dict[str, tuple[list[int], list[tuple[int, int, int]]]] = {}
    for source, size, i, piece in items:
        queues.setdefault(source, ([], []))[1].append((size, -i, -piece))
    for sizes, queue in queues.values():
        queue.sort()
        sizes.extend(q[0] for q in queue)
    # a deficit is what stood at the start, plus the share of all that was packed, less what the source gave
    given: dict[str, int] = dict.fromkeys(queues, 0)
    packed = 0
    out: list[list[tuple[str, int, int, int]]] = []
    left = len(items)
    while left:
        room, box = capacity, []
        while room:
            pick, behind = None, 0.0
            for source, (sizes, _) in queues.items():
                if sizes[0] <= room:
                    d = deficit.get(source, 0.0) + share.get(source, 0.0) * packed - given[source]
                    if pick is None or d > behind or (d == behind and source < pick):
                        pick, behind = source, d
            if pick is None:
                break
            sizes, queue = queues[pick]
            at = bisect_right(sizes, room) - 1
            size, i, piece = queue.pop(at)
            sizes.pop(at)
            if not queue:
                del queues[pick]
            box.append((pick, size, -i, -piece))
            room -= size
            left -= 1
            packed += size
            given[pick] += size
        out.append(box)
    for s in {*share, *given}:
        deficit[s] = deficit.get(s, 0.0) + share.get(s, 0.0) * packed - given.get(s, 0)
    return out


def _pack_shard(table: pa.Table, sources: pa.Table) -> pa.Table:
    if not table.num_rows:
        return _OUT.empty_table()
    window, capacity, shard = (table.column(c)[0].as_py() for c in ("window_name", "capacity_tokens", "shard"))
    share, deficit = {}, {}
    for s in sources.to_pylist():
        share[s["source"]], deficit[s["source"]] = s["share"], s["behind"]
    whole, items = [], []
    for i, source, tokens in zip(table.column("doc_id").to_pylist(), table.column("source").to_pylist(), table.column("tokens").to_pylist()):
        full, rest = divmod(tokens, capacity) if tokens > capacity else (0, tokens)
        whole += [(source, capacity, i, k) for k in range(full)]
        if rest or not full:
            items.append((source, rest, i, full))
    empty = [i for i in items if not i[1]]
    boxes = fill(whole + [i for i in items if i[1]], capacity, share, deficit)
    # documents without tokens need no room: they stand in the shard's first container
    if empty:
        boxes[:1] = [(boxes[0] if boxes else []) + sorted(empty, key=lambda e: e[2])]
    out = [(window, capacity, shard, n, i, piece, source, piece * capacity, size) for n, box in enumerate(boxes) for source, size, i, piece in box]
    return pa.table([pa.array([o[k] for o in out], f.type) for k, f in enumerate(_OUT)], schema=_OUT)


def _before(sums: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``sums`` with the sum of ``value`` over the earlier shards of the same ``keys``: over whole ranges of shards, then within one."""
    ranged = sums.withColumn("_range", F.floor(F.col("shard") / RANGE))
    past = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum")).withColumn("_past", F.coalesce(F.sum("_sum").over(past(keys, "_range")), F.lit(0))).drop("_sum")
    inner = ranged.withColumn("_inner", F.coalesce(F.sum(value).over(past([*keys, "_range"], "shard")), F.lit(0)))
    return inner.join(ranges, [*keys, "_range"]).withColumn(name, F.col("_past") + F.col("_inner")).drop("_range", "_past", "_inner")


def own_shares(counts: DataFrame) -> DataFrame:
    """(source, share): each source's share of all tokens."""
    sums = counts.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"))
    total = sums.agg(F.sum("tokens")).first()[0] or 1
    return sums.select("source", (F.col("tokens") / F.lit(total)).alias("share"))


def damped_shares(counts: DataFrame, power: float = 0.5) -> DataFrame:
    """(source, share): shares of tokens raised to a power, so that small sources get more than they have."""
    raised = own_shares(counts).withColumn("share", F.pow("share", F.lit(power)))
    total = raised.agg(F.sum("share")).first()[0] or 1.0
    return raised.withColumn("share", F.col("share") / F.lit(total))


def pack(counts: DataFrame, windows: DataFrame, shares: DataFrame | None = None, shard_containers: int = SHARD_CONTAINERS) -> DataFrame:
    """One row per piece of document and window: window_name, capacity_tokens, shard, container (unique within window and
    shard), doc_id, piece, source, start_token and tokens.

    ``counts``: doc_id (unique), source, tokens. ``windows``: window_name, capacity_tokens (at most ``MOST_WINDOWS``, which is checked;
    those without a positive capacity are left out). ``shares``: source, share (target proportions that add up to 1; 0 for a source
    that is not named); without it, each source's share of all tokens. Targets are met until a source runs out. A null source is the
    source ''; null counts are 0. Every document is placed in every window."""
    counts = counts.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))
    own = own_shares(counts)
    shares = own if shares is None else shares
    sizes = windows.where("capacity_tokens > 0").select("window_name", F.col("capacity_tokens").cast("int").alias("capacity_tokens")).distinct().limit(MOST_WINDOWS + 1).collect()
    if len(sizes) > MOST_WINDOWS:
        raise ValueError(f"more than {MOST_WINDOWS} windows")
    total = counts.agg(F.sum("tokens")).first()[0] or 0
    kinds = "array<struct<window_name:string,capacity_tokens:int,shards:int>>"
    literal = F.array(*(F.struct(F.lit(w).alias("window_name"), F.lit(c).alias("capacity_tokens"), F.lit(max(1, -(-total // (c * shard_containers)))).cast("int").alias("shards")) for w, c in sizes)).cast(kinds)
    dealt = counts.select("*", F.explode(literal).alias("w")).select("doc_id", "source", "tokens", "w.*").withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.col("shards")).cast("int"))
    # how far the shards before are from each source's part of all tokens; a shard needs this of its own sources only
    held = dealt.groupBy("window_name", "capacity_tokens", "shard", "source").agg(F.sum("tokens").alias("held"))
    whole = held.groupBy("window_name", "capacity_tokens", "shard").agg(F.sum("held").alias("held"))
    earlier = _before(whole, ["window_name", "capacity_tokens"], "held", "earlier").drop("held")
    mine = _before(held, ["window_name", "capacity_tokens", "source"], "held", "mine")
    carried = mine.join(earlier, ["window_name", "capacity_tokens", "shard"]).join(shares.select("source", "share"), "source", "left").join(own.withColumnRenamed("share", "_own"), "source")
    carried = carried.select("window_name", "capacity_tokens", "shard", "source", F.coalesce("share", F.lit(0.0)).alias("share"), (F.col("_own") * F.col("earlier") - F.col("mine")).alias("behind")).toDF("in_window", "in_capacity", "in_shard", "source", "share", "behind")
    schema = "window_name string, capacity_tokens int, shard int, container int, doc_id long, piece int, source string, start_token long, tokens long"
    return dealt.drop("shards").groupBy("window_name", "capacity_tokens", "shard").cogroup(carried.groupBy("in_window", "in_capacity", "in_shard")).applyInArrow(_pack_shard, schema)


def mixture(packed: DataFrame, shares: DataFrame, run: int = 64) -> DataFrame:
    """(window_name, capacity_tokens, tenth, runs, distance): how far the mixture of ``run`` containers in a row is from the target, as
    total variation (0: as asked, 1: nothing of what was asked), on average over the runs in each tenth of their shard."""
    keys = ["window_name", "capacity_tokens", "shard"]
    last = packed.groupBy(*keys).agg((F.max("container") + 1).alias("_containers"))
    place = packed.join(last, keys).withColumn("_run", F.floor(F.col("container") / run)).withColumn("tenth", F.floor(F.col("_run") * run * 10 / F.col("_containers")).cast("int"))
    got = place.groupBy(*keys, "tenth", "_run", "source").agg(F.sum("tokens").alias("tokens"))
    all_ = got.groupBy(*keys, "tenth", "_run").agg(F.sum("tokens").alias("_all")).where("_all > 0")
    part = got.join(all_, [*keys, "tenth", "_run"]).join(shares.select("source", "share"), "source", "left")
    share, have = F.coalesce("share", F.lit(0.0)), F.col("tokens") / F.col("_all")
    far = part.groupBy(*keys, "tenth", "_run").agg(((F.sum(F.abs(have - share) - share) + 1) / 2).alias("far"))
    return far.groupBy("window_name", "capacity_tokens", "tenth").agg(F.count("*").alias("runs"), F.round(F.avg("far"), 4).alias("distance"))


def room_left(packed: DataFrame) -> DataFrame:
    """(window_name, capacity_tokens, containers, tokens, filled): how full the containers of each window are."""
    boxes = packed.groupBy("window_name", "capacity_tokens", "shard", "container").agg(F.sum("tokens").alias("tokens"))
    sums = boxes.groupBy("window_name", "capacity_tokens").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
    return sums.withColumn("filled", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4))
