"""Removal of repeated byte strings with a sparse suffix array, sorted deep-shallow.

Sorting every suffix of a corpus would shuffle it a hundred times over. A string of ``LENGTH`` bytes
holds one or more anchors: starts of ``CORE`` bytes whose hash is the smallest in the string. Equal
strings have equal anchors at equal places, so only suffixes at anchors are sorted:

1. Anchors are counted by the hash of their core; a core that occurs once repeats nothing.
2. An anchor's context holds all strings it lies in. Contexts that occur twice repeat as a whole.
3. Contexts that share the core only are sorted in tasks, from the core on and, reversed, from
   it backwards: multikey quicksort to a shallow depth, then blind tries for the groups
   that still agree. Common prefixes of neighbours tell which strings occur twice.
4. Groups too large for a task are split first: strings are divided by where they start, and each
   half is grouped by the longer core that its strings share.

All decisions that step 3 makes are made on bytes. Steps 2 and 4 compare two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from requestmill.llm.common import sliced, worker_state, written

LENGTH = 200
CORE = 100
REACH = LENGTH - CORE  # a string starts at most so many bytes before its anchor
SHALLOW = 16
BLOCK = 1 << 20  # bytes of a long text searched at once
TOGETHER = 1 << 17  # bytes of short texts searched at once
GROUP_LIMIT = 20_000
TASK_CONTEXTS = 30_000
FILTER_BITS = 1 << 29


# --- anchors ---------------------------------------------------------------------------------


def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of bytes, and powers of an odd base and of its inverse modulo 2^64."""
    state = worker_state()
    known = state.get("powers")
    if known is None or len(known[1]) < size:
        base = 0x9E3779B97F4A7C15

        def powers(b: int) -> np.ndarray:
            out = np.full(size, b, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        codes = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
        known = (codes, powers(base), powers(pow(base, -1, 1 << 64)))
        state["powers"] = known
    return known


def _sliding(a: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` of each run of ``width`` values, from runs of half the width."""
    done = 1
    out = a
    while 2 * done <= width:
        out = best(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return best(out[:-rest], out[rest:]) if rest else out


def _anchors_side_by_side(texts: list[bytes]) -> list[list[int]]:
    """Anchors of texts laid one after the other; strings across two texts do not count."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    if ends[-1] < LENGTH:
        return [[] for _ in texts]
    codes = np.frombuffer(b"".join(texts), np.uint8)
    n = len(codes)
    table, up, down = _tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[codes] * up[:n], out=sums[1:])
    h = (sums[CORE:] - sums[:-CORE]) * down[: n - CORE + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) | np.uint64(1)
    width = REACH + 1
    lowest = _sliding(h, width, np.minimum)
    for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
        lowest[max(0, end - min(size, LENGTH - 1)) : end] = 0  # no string starts here
    edge = np.zeros(width - 1, np.uint64)
    highest = _sliding(np.concatenate([edge, lowest, edge]), width, np.maximum)
    found = np.flatnonzero(h == highest)
    cuts = np.searchsorted(found, ends).tolist()
    out, first = [], 0
    for cut, start in zip(cuts, (ends - sizes).tolist(), strict=True):
        out.append((found[first:cut] - start).tolist())
        first = cut
    return out


def anchors(data: bytes) -> list[int]:
    """Starts of the smallest cores of all strings; depends on the strings alone."""
    strings = len(data) - LENGTH + 1
    found: set[int] = set()
    for start in range(0, strings, BLOCK):
        part = data[start : start + BLOCK + LENGTH - 1]
        found.update(start + at for at in _anchors_side_by_side([part])[0])
    return sorted(found)


def anchors_of_each(texts: list[bytes]) -> list[list[int]]:
    """The same for several texts; short ones are searched together."""
    out: list[list[int]] = []
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        if size > TOGETHER:
            out.append(anchors(texts[at]))
        else:
            while end < len(texts) and size + len(texts[end]) <= TOGETHER:
                size += len(texts[end])
                end += 1
            out += _anchors_side_by_side(texts[at:end])
        at = end
    return out


def _core_hash(data: bytes, at: int) -> int:
    return xxhash.xxh3_64_intdigest(data[at : at + CORE])


def _range(size: int, at: int) -> tuple[int, int]:
    """How far before the anchor strings start: least and most."""
    return max(0, LENGTH - (size - at)), min(REACH, at)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _core_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 2048):
        texts = [t or b"" for t in batch.column(0).to_pylist()]
        found: list[int] = []
        for data, places in zip(texts, anchors_of_each(texts), strict=True):
            found += [_core_hash(data, at) for at in places]
        cores, n = np.unique(_signed(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cores), pa.array(n, pa.int64())], ["core", "n"])


# --- filters of hashes -----------------------------------------------------------------------


def _bit_filter(cores: DataFrame, count: int) -> np.ndarray:
    """A bit set that holds all hashes and few others, of bounded size. What passes it wrongly is
    found out later, so a full filter costs time, not correctness."""
    bits = 1 << 16
    while bits < 16 * count and bits < FILTER_BITS:
        bits *= 2
    at = F.col("core").bitwiseAND(F.lit(bits - 1))
    words = cores.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(core & 63 as int))")).alias("bits")
    )
    rows = words.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(bits: np.ndarray, cores: list[int]) -> np.ndarray:
    at = np.array(cores, np.uint64) & np.uint64(len(bits) * 64 - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


# --- anchors and contexts that may repeat ----------------------------------------------------


def _context(data: bytes, at: int, low: int, high: int) -> bytes:
    return data[at - high : at + LENGTH - low]


def _anchor_batches(bits, with_body: bool):
    """Anchors whose core passes the filter; each context once for each batch if bodies are
    asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_bits = bits.value
        for batch in sliced(batches, 2048):
            rows: list[int] = []
            at_, low_, high_, core_, context_ = [], [], [], [], []
            bodies: list[bytes] = []
            seen: set[tuple[int, int]] = set()
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            each = anchors_of_each(texts)
            for row, (data, places) in enumerate(zip(texts, each, strict=True)):
                cores = [_core_hash(data, at) for at in places]
                for k in np.flatnonzero(_passes(filter_bits, cores)).tolist():
                    at, core = places[k], cores[k]
                    low, high = _range(len(data), at)
                    body = _context(data, at, low, high)
                    context = xxhash.xxh3_64_intdigest(body, seed=low << 8 | high)
                    if with_body:
                        if (core, context) in seen:
                            continue
                        seen.add((core, context))
                        bodies.append(body)
                    rows.append(row)
                    at_.append(at)
                    low_.append(low)
                    high_.append(high)
                    core_.append(core)
                    context_.append(context)
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                batch.column(1).take(pa.array(rows, pa.int64())),
                pa.array(at_, pa.int32()),
                pa.array(low_, pa.int32()),
                pa.array(high_, pa.int32()),
                pa.array(_signed(core_)),
                pa.array(_signed(context_)),
            ]
            names = ["doc_id", "text_hash", "at", "low", "high", "core", "context"]
            if with_body:
                columns.append(pa.array(bodies, pa.binary()))
                names.append("body")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


ANCHOR = "doc_id long, text_hash long, at int, low int, high int, core long, context long"


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id and hash of the text tell rows apart; rows equal in both have equal results."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("binary")).alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    )


# --- deep-shallow sort -----------------------------------------------------------------------


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie_order(suffixes: list[bytes], members: list[int]) -> tuple[list[int], list[int]]:
    """Members in order, and each one's common prefix with the one before it.

    Inner nodes keep a depth and the bytes found there, nothing in between. A suffix goes down
    blindly to a leaf, is compared with it once, and branches off where they part.
    """
    # an inner node is [depth, {byte: node}], a leaf ["leaf", members with equal suffixes]
    root: list = [0, {}]

    def byte(s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else -1

    for m in members:
        s = suffixes[m]
        if not root[1]:
            root[1][byte(s, 0)] = ["leaf", m]
            continue
        node, path = root, []
        while node[0] != "leaf":
            path.append(node)
            kids = node[1]
            key = byte(s, node[0])
            # where no edge fits, any leaf below shares what has to be compared
            node = kids[key] if key in kids else next(iter(kids.values()))
        other = suffixes[node[1]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node.append(m)
            continue
        while path[-1][0] > depth:
            path.pop()
        parent = path[-1]
        if parent[0] == depth:
            parent[1][byte(s, depth)] = ["leaf", m]
        else:
            edge = byte(s, parent[0])
            branches = {byte(other, depth): parent[1][edge], byte(s, depth): ["leaf", m]}
            parent[1][edge] = [depth, branches]

    order, lcps = [], []
    stack: list = [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if node[0] == "leaf":
            for k, m in enumerate(node[1:]):
                order.append(m)
                lcps.append(shared if k == 0 else len(suffixes[m]))
            continue
        kids = sorted(node[1].items(), reverse=True)
        last = len(kids) - 1
        for k, (_, kid) in enumerate(kids):
            stack.append((kid, shared if k == last else node[0]))
    return order, lcps


def deep_shallow_sort(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, and each one's common prefix with the one before it.

    Multikey quicksort by eight bytes at a time to the shallow depth; groups that still agree
    there go to blind tries.
    """
    n = len(suffixes)
    heads = np.frombuffer(
        b"".join([s[:SHALLOW].ljust(SHALLOW, b"\0") for s in suffixes]), ">u8"
    ).reshape(n, -1)
    order: list[int] = []
    lcps: list[int] = []
    stack = [(np.arange(n), 0)]
    while stack:
        part, depth = stack.pop()
        if len(part) == 1 or depth == heads.shape[1]:
            members = part.tolist()
            found, shared = blind_trie_order(suffixes, members)
            shared[0] = common_prefix(suffixes[order[-1]], suffixes[found[0]]) if order else 0
            order += found
            lcps += shared
            continue
        keys = heads[part, depth]
        pivot = keys[len(keys) // 2]
        for chosen, deeper in ((keys > pivot, 0), (keys == pivot, 1), (keys < pivot, 0)):
            if chosen.any():
                stack.append((part[chosen], depth + deeper))
    return np.array(order, np.int64), np.array(lcps, np.int64)


def repeated_strings(
    bodies: list[bytes], lows: np.ndarray, highs: np.ndarray, first: int, last: int
) -> tuple[np.ndarray, np.ndarray]:
    """For contexts that may share the core between ``first`` and ``last``: the least and the most
    bytes before the anchor at which a string starts that another context has there, too; the
    least is above the most where there is none.

    A body holds the strings that start ``lows`` to ``highs`` bytes before the anchor.
    """
    n = len(bodies)
    core = LENGTH - (last - first)
    cuts = (highs - first).tolist()
    ahead = [b[c:] for b, c in zip(bodies, cuts, strict=True)]
    back = [b[: c + core][::-1] for b, c in zip(bodies, cuts, strict=True)]
    order_a, lcp_a = deep_shallow_sort(ahead)
    order_b, lcp_b = deep_shallow_sort(back)
    least, most = np.full(n, LENGTH + 1), np.full(n, -1)
    group_a, group_b = np.empty(n, np.int64), np.empty(n, np.int64)
    for start in range(first, last + 1):
        # one number for all that agree up to the string's end, one for all up to its start
        group_a[order_a] = np.cumsum(lcp_a < core + last - start)
        group_b[order_b] = np.cumsum(lcp_b < core + start - first)
        both = group_a * (n + 1) + group_b
        rank = np.argsort(both, kind="stable")
        same = both[rank][1:] == both[rank][:-1]
        again = np.zeros(n, bool)
        again[rank[1:][same]] = True
        again[rank[:-1][same]] = True
        again &= (lows <= start) & (start <= highs)
        least[again] = np.minimum(least[again], start)
        most[again] = np.maximum(most[again], start)
    return least, most


def _sort_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All contexts of a partition; groups lie in it whole."""
    for (first, last), table in _by_range(batches):
        lows, highs = table.column("low").to_numpy(), table.column("high").to_numpy()
        least, most = repeated_strings(table.column("body").to_pylist(), lows, highs, first, last)
        found = np.flatnonzero((least <= most) & table.column("alone").to_numpy())
        at = table.column("at").to_numpy()[found]
        keep = pa.array(found)
        yield pa.RecordBatch.from_arrays(
            [
                table.column("doc_id").combine_chunks().take(keep),
                table.column("text_hash").combine_chunks().take(keep),
                pa.array((at - most[found]).astype(np.int32)),
                pa.array((at + LENGTH - least[found]).astype(np.int32)),
            ],
            ["doc_id", "text_hash", "start", "end"],
        )


def _by_range(batches: Iterator[pa.RecordBatch]):
    """Tables of a partition by the range of starts; the number of ranges is fixed."""
    found = list(batches)
    if not found:
        return
    table = pa.Table.from_batches(found)
    first, last = table.column("first").to_numpy(), table.column("last").to_numpy()
    for key in np.unique(first * 1000 + last).tolist():
        picked = np.flatnonzero(first * 1000 + last == key)
        yield (key // 1000, key % 1000), table.take(pa.array(picked))


# --- groups --------------------------------------------------------------------------------


def _bytes_hash(body: Column, low: Column, high: Column) -> Column:
    return F.xxhash64(body, low, high)


def _halves(items: DataFrame) -> DataFrame:
    """Each context cut into the strings of the lower and of the upper half of the starts, with the
    longer core that all strings of the half share."""
    middle = F.floor((F.col("first") + F.col("last")) / 2).cast("int")
    half = F.explode(
        F.array(
            F.struct(F.col("first").alias("f"), middle.alias("l")),
            F.struct((middle + 1).alias("f"), F.col("last").alias("l")),
        )
    )
    cut = items.where("first < last").select("*", half.alias("h"))
    low, high = F.greatest("low", "h.f"), F.least("high", "h.l")
    cut = cut.withColumns({"new_low": low, "new_high": high}).where("new_low <= new_high")
    body = F.expr(
        f"substring(body, high - new_high + 1, {LENGTH} + new_high - new_low)"
    )
    cut = cut.withColumn("new_body", body)
    core = F.expr(f"substring(new_body, new_high - h.f + 1, {LENGTH} - (h.l - h.f))")
    return cut.select(
        "doc_id",
        "text_hash",
        "at",
        F.col("new_low").alias("low"),
        F.col("new_high").alias("high"),
        F.xxhash64(core, F.col("h.f")).alias("core"),
        _bytes_hash(F.col("new_body"), F.col("new_low"), F.col("new_high")).alias("context"),
        F.col("new_body").alias("body"),
        F.col("h.f").alias("first"),
        F.col("h.l").alias("last"),
        "alone",
    )


GROUP = ["first", "last", "core"]
SPAN = "doc_id long, text_hash long, start int, end int"


def _span_columns() -> list[Column]:
    return [
        F.col("doc_id"),
        F.col("text_hash"),
        (F.col("at") - F.col("high")).cast("int").alias("start"),
        (F.col("at") + LENGTH - F.col("low")).cast("int").alias("end"),
    ]


def _sorted_spans(items: DataFrame) -> list[DataFrame]:
    """Spans of contexts that share a core with other contexts; ``items`` are written and hold each
    context once. Groups beyond the limit are halved until they fit or are decided."""
    found: list[DataFrame] = []
    while True:
        sizes = items.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("members"))
        sized = written(sizes.where("members > 1"), "group-sizes")
        fits = sized.where(F.col("members") <= GROUP_LIMIT)
        total = fits.agg(F.sum("members")).first()[0] or 0
        if total:
            parts = max(2, -(-total // TASK_CONTEXTS))
            small = items.join(fits.select(*GROUP), GROUP, "left_semi")
            spread = small.repartition(parts, *GROUP).select(
                "doc_id", "text_hash", "at", "low", "high", "body", "first", "last", "alone"
            )
            found.append(written(spread.mapInArrow(_sort_batches, SPAN), "sorted-spans"))
        large = sized.where(F.col("members") > GROUP_LIMIT)
        if large.isEmpty():
            return found
        halves = written(
            _halves(items.join(large.select(*GROUP), GROUP, "left_semi")), "halves"
        )
        counts = halves.groupBy(*GROUP, "context").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "at")).alias("one")
        )
        both = halves.join(counts, [*GROUP, "context"])
        found.append(written(both.where("n > 1 AND alone").select(*_span_columns()), "half-spans"))
        # one of each context goes on, for others to be compared with
        one = F.struct("doc_id", "text_hash", "at").eqNullSafe(F.col("one"))
        items = written(
            both.where(one).withColumn("alone", F.col("alone") & (F.col("n") == 1)).select(
                *halves.columns
            ),
            "half-items",
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end) of byte ranges that strings of ``LENGTH`` bytes cover which
    start anywhere else as well. Ranges may overlap."""
    spark = docs.sparkSession
    rows = _documents(docs)
    cores = rows.select("text").mapInArrow(_core_batches, "core long, n long")
    twice = written(
        cores.groupBy("core").agg(F.sum("n").alias("n")).where("n > 1").select("core"), "cores"
    )
    count = twice.count()
    if not count:
        return spark.createDataFrame([], SPAN)
    bits = spark.sparkContext.broadcast(_bit_filter(twice, count))  # 64 MB at most
    found = written(rows.mapInArrow(_anchor_batches(bits, False), ANCHOR), "anchors")
    contexts = written(
        found.groupBy("core", "context").agg(F.count(F.lit(1)).alias("n")), "contexts"
    )
    whole = found.join(contexts.where("n > 1").select("core", "context"), ["core", "context"])
    spans = [whole.select(*_span_columns())]
    # cores with a context of their own and another one
    unsure = written(
        contexts.groupBy("core")
        .agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least"))
        .where("contexts > 1 AND least = 1")
        .select("core"),
        "unsure",
    )
    count = unsure.count()
    if count:
        bits = spark.sparkContext.broadcast(_bit_filter(unsure, count))
        bodies = rows.mapInArrow(_anchor_batches(bits, True), f"{ANCHOR}, body binary")
        # what passed the filter wrongly goes here; each context stays once
        known = contexts.join(unsure, "core", "left_semi")
        matched = bodies.join(known, ["core", "context"]).dropDuplicates(["core", "context"])
        items = matched.select(
            "doc_id",
            "text_hash",
            "at",
            "low",
            "high",
            "core",
            "context",
            "body",
            F.lit(0).alias("first"),
            F.lit(REACH).alias("last"),
            (F.col("n") == 1).alias("alone"),
        )
        spans += _sorted_spans(written(items, "items"))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


# --- removal ---------------------------------------------------------------------------------


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 2048):
        runs, kept = [], []
        for text, found in zip(batch.column(1), batch.column(2), strict=True):
            data = text.as_py() or b""
            spans = merged([(s["start"], s["end"]) for s in found.as_py() or []])
            runs.append([{"start": a, "end": b} for a, b in spans])
            done, parts = 0, []
            for a, b in spans:
                parts.append(data[done:a])
                done = b
            kept.append(b"".join([*parts, data[done:]]))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(3), pa.array(runs, kind), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept), one row for each row of ``docs``.

    spans are the removed byte ranges, kept is what is left of the text's UTF-8 bytes. Texts under
    ``LENGTH`` bytes, null and empty ones lose nothing. Rows given twice repeat each other.
    An empty table gives no rows. Other columns are not read.
    """
    spans = repeated_spans(docs)
    # a row's spans are bounded by its own length
    per_row = spans.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")
    )
    per_row = written(per_row, "row-spans").select(
        F.col("doc_id").alias("__llm_id"), F.col("text_hash").alias("__llm_hash"), "spans"
    )
    rows = _documents(docs)
    same = rows.doc_id.eqNullSafe(F.col("__llm_id")) & (rows.text_hash == F.col("__llm_hash"))
    joined = rows.join(per_row, same, "left").select(
        "doc_id", "text", "spans", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes")
    )
    return joined.select(
        "doc_id", "text", "spans", F.col("n_bytes").cast("long").alias("n_bytes")
    ).mapInArrow(
        _cut_batches,
        "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary",
    )
