"""Removal of bytes that an earlier occurrence of the same ``LENGTH``-byte string covers.

Only suffixes at anchors are sorted. The anchor of a ``LENGTH``-byte window is the place of the
least hash among its ``GRAM``-byte strings (leftmost of equal ones), so equal windows have their
anchor at the same place, and one window in about forty starts a new one. The windows of an
anchor lie in its context, at most LENGTH - GRAM bytes before it and LENGTH bytes from it.

1. Anchor hashes are counted; those met once cannot repeat. The others are marked in a bitmap
   that goes to the tasks (up to ``MOST_MARKS`` bytes; beyond it they are joined by hash).
2. Hashes of the contexts at repeated anchors are gathered by anchor hash; all but the first of
   equal contexts are covered. They are merged in each batch before the shuffle, so a passage
   of a third of all documents is one row a batch.
3. Where different contexts share an anchor hash their bytes are fetched. In such a group the
   right sides, and the reversed left sides, are ordered by deep-shallow sorting: multikey
   quicksort to ``SHALLOW`` bytes, then a blind trie for every group that is still tied. The
   common prefixes of neighbours give, for every window around the anchor, classes of contexts that
   agree in it; the windows in which an earlier context agrees cover one run of bytes around it.
   Memory is in proportion to the contexts, no two of them are paired.
4. Groups with more contexts than ``HOT`` (and a millionth of all anchors) are spread by the
   content of each window instead; equal windows then meet, whatever surrounds them.

Matches never cross documents. Null text is empty. Rows with equal doc_id are ordered by a hash
of their texts (null ids first); rows equal in both are one document and get one result each.
An empty table gives no rows. A text's order is that of the input, not of what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import textvec
from shelfwise.session import staged

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams of a window
SHALLOW = 16
HOT = 4096
HOT_SHARE = 1_000_000
MOST_MARKS = 64 << 20
SLICES = 64
#: Windows of contexts that are classed at a time.
WINDOW_CELLS = 1 << 19
#: Bytes searched together; places in them must fit into the low bits of a packed hash.
BLOCK = 1 << 20
_LOW = np.uint64(BLOCK - 1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def anchors(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Contexts of all texts: owner (text), start (of the first window, in its text), size, at (the anchor after start),
    gram (hash, 44 bits), content (hash of the context), begin (in data)."""
    out = {k: [] for k in ("owner", "start", "size", "at", "gram", "content", "begin")}
    first = 0
    while len(data) - first >= LENGTH:
        part = data[first:first + BLOCK]
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * textvec.powers(_BASE, n), out=sums[1:])
        back = textvec.powers(_BASE_INVERSE, n)
        grams = textvec.mix((sums[GRAM:] - sums[:-GRAM]) * back[:n - GRAM + 1])
        packed = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        least, width = packed, 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SPAN - width
        least = np.minimum(least[:len(least) - rest], least[rest:])  # one for each window
        inside = np.ones(len(least), bool)
        for end in bounds[(bounds > first) & (bounds < first + n)] - first:
            inside[max(0, end - LENGTH + 1):end] = False
        start = np.flatnonzero(inside)
        if len(start):
            place = least[start]
            # A run is of neighbouring windows with one anchor.
            new = np.ones(len(start), bool)
            new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
            opens = np.flatnonzero(new)
            last = np.append(opens[1:], len(start)) - 1
            begin, end = start[opens], start[last] + LENGTH
            owner = np.searchsorted(bounds, first + begin, "right") - 1
            out["owner"].append(owner)
            out["start"].append(first + begin - bounds[owner])
            out["size"].append(end - begin)
            out["at"].append((place[opens] & _LOW).astype(np.int64) - begin)
            out["gram"].append(place[opens] >> np.uint64(20))
            out["content"].append(textvec.mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64)))
            out["begin"].append(first + begin)
        if first + n >= len(data):
            break
        first += n - LENGTH + 1
    kinds = {"gram": np.uint64, "content": np.uint64}
    return {k: np.concatenate(v) if v else np.zeros(0, kinds.get(k, np.int64)) for k, v in out.items()}


def _row_key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash")]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*_row_key(), "text")


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """gram, n of all anchor hashes that come twice or more, equal contexts of a batch counted as two at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in textvec.pieces(texts, 8 << 20):
                found = anchors(*textvec.packed(texts[begin:end]))
                gram, times = np.unique(found["gram"], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(times.astype(np.int32))], ["gram", "n"])

    return (docs.select("text").mapInArrow(run, "gram long, n int").groupBy("gram").agg(F.sum("n").alias("n"))
            .filter("n >= 2"))


def marks(repeated: DataFrame, n: int) -> tuple[int, dict[int, bytes]]:
    """A bitmap with about 16 bits for each repeated hash, in slices; its logarithm of bits."""
    depth = max(16, int(np.ceil(np.log2(max(1, 16 * n)))))
    each = 1 << (depth - 6)

    def run(rows):
        import pandas as pd

        bits = np.zeros(each, bool)
        bits[rows["bit"].to_numpy() % each] = True
        return pd.DataFrame({"slice": rows["slice"][:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    bit = F.col("gram").bitwiseAND(F.lit((1 << depth) - 1))
    rows = (repeated.select(bit.alias("bit")).withColumn("slice", F.floor(F.col("bit") / each).cast("int"))
            .groupBy("slice").applyInPandas(run, "slice int, bits binary"))
    return depth, {r.slice: bytes(r.bits) for r in rows.collect()}


def _select(found: dict[str, np.ndarray], chosen: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[chosen] for k, v in found.items()}


def _windows(found: dict[str, np.ndarray], data: np.ndarray) -> dict[str, np.ndarray]:
    """Contexts of single windows, with a key of their own content, for groups that are too large."""
    count = found["size"] - LENGTH + 1
    which = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    out = _select(found, which)
    out["start"], out["begin"], out["at"] = out["start"] + step, out["begin"] + step, out["at"] - step
    out["size"] = np.full(len(which), LENGTH)
    table = data[out["begin"][:, None] + np.arange(LENGTH)].astype(np.uint64) + np.uint64(1)
    out["content"] = textvec.mix((table * textvec.powers(_BASE, LENGTH)).sum(axis=1, dtype=np.uint64))
    out["gram"] = textvec.mix(out["content"] ^ out["gram"])
    return out


CONTEXTS = "kind int, gram long, content long, _id long, _text_hash long, start long, size long, at int"
_NAMES = [c.split()[0] for c in CONTEXTS.split(", ")]
_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
CONTEXT, COVERED = 0, 1


def _merged(doc: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of each document, overlapping ones joined."""
    order = np.lexsort((start, text, doc))
    doc, text, start, end = doc[order], text[order], start[order], (start + size)[order]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
    # Ends grow by document number, so that a running maximum never reaches into the next one.
    shift = np.cumsum(other) * np.int64(1 << 40)
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + shift[1:] > reach[:-1]
    opens = np.flatnonzero(new)
    last = np.append(opens[1:], len(doc)) - 1
    return doc[opens], text[opens], start[opens], reach[last] - shift[last] - start[opens]


def _settled(gram: np.ndarray, content: np.ndarray, doc: np.ndarray, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the first of equal contexts (108 bits of hash), and which of the others are covered.

    Equal rows (id and text) are one document.
    """
    order = np.lexsort((start, text, doc, content, gram))
    g, c = gram[order], content[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    lead = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
    same = (doc[order] == doc[lead]) & (text[order] == text[lead]) & (start[order] == start[lead])
    return order[first], order[~first & ~same]


def _row_batch(kind: int, *columns) -> pa.RecordBatch:
    n = len(columns[2])
    full = [np.full(n, kind), *(np.zeros(n, np.int64) if c is None else c for c in columns)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32 if t == pa.int32() else np.int64)) for c, t in zip(full, _KINDS, strict=True)],
                                      _NAMES)


def contexts(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Contexts at repeated anchors, and runs of bytes that a batch itself shows to be covered; no text."""
    total = repeated.agg(F.count(F.lit(1)).alias("hashes"), F.sum("n").alias("n")).first()
    bound = max(HOT, (total.n or 0) // HOT_SHARE)
    hot = np.sort(np.array([r.gram for r in repeated.filter(F.col("n") > bound).select("gram").collect()], np.int64))
    screened = 2 * total.hashes <= MOST_MARKS
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((hot, *marks(repeated, total.hashes)) if screened else (hot, 0, {}))
    rows = _rows(docs)
    if not screened:
        def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(2).to_pylist()
                for begin, end in textvec.pieces(texts, 8 << 20):
                    found = anchors(*textvec.packed(texts[begin:end]))
                    owner = pa.array(found["owner"] + begin)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), batch.column(1).take(owner),
                                                      pa.array(found["gram"].astype(np.int64))], ["_id", "_text_hash", "gram"])

        known = (rows.mapInArrow(list_anchors, "_id long, _text_hash long, gram long").join(repeated.select("gram"), "gram")
                 .groupBy("_id", "_text_hash").agg(F.collect_set("gram").alias("known")))
        rows = rows.join(known, ["_id", "_text_hash"])
    else:
        rows = rows.withColumn("known", F.lit(None).cast("array<long>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, depth, slices = sent.value
        bitmap = None
        if screened:
            each = 1 << (depth - 9)  # bytes of a slice
            bitmap = np.frombuffer(b"".join(slices.get(i, bytes(each)) for i in range(SLICES)), np.uint8)
        for batch in batches:
            ids, hashes = (batch.column(c).to_numpy() for c in (0, 1))
            texts = batch.column(2).to_pylist()
            known = batch.column(3).to_pylist()
            for begin, end in textvec.pieces(texts, 8 << 20):
                data, bounds = textvec.packed(texts[begin:end])
                found = anchors(data, bounds)
                if screened:
                    bit = found["gram"] & np.uint64((1 << depth) - 1)
                    live = (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).view(bool)
                else:
                    live = np.zeros(len(found["gram"]), bool)
                    for i in range(begin, end):
                        mine = found["owner"] == i - begin
                        live[mine] = np.isin(found["gram"][mine].astype(np.int64), known[i])
                found = _select(found, live)
                if len(hot) and len(found["gram"]):
                    many = np.isin(found["gram"].astype(np.int64), hot)
                    if many.any():
                        apart = _windows(_select(found, many), data)
                        found = {k: np.concatenate([v[~many], apart[k]]) for k, v in found.items()}
                if not len(found["gram"]):
                    continue
                doc, text = ids[found["owner"] + begin], hashes[found["owner"] + begin]
                keep, gone = _settled(found["gram"], found["content"], doc, text, found["start"])
                yield _row_batch(CONTEXT, found["gram"][keep], found["content"][keep].view(np.int64), doc[keep], text[keep],
                                 found["start"][keep], found["size"][keep], found["at"][keep])
                if len(gone):
                    d, t, start, size = _merged(doc[gone], text[gone], found["start"][gone], found["size"][gone])
                    yield _row_batch(COVERED, None, None, d, t, start, size, None)

    return rows.select("_id", "_text_hash", "text", "known").mapInArrow(run, CONTEXTS)


def settled(found: DataFrame) -> DataFrame:
    """Covered runs, and the contexts whose anchor hash has other contexts too.

    One shuffle by anchor hash; a task goes through its groups one batch after the other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def close(rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            gram, content, doc, text, start, size, at = rows
            keep, gone = _settled(gram, content, doc, text, start)
            if len(gone):
                yield _row_batch(COVERED, None, None, *_merged(doc[gone], text[gone], start[gone], size[gone]), None)
            g = gram[keep]
            several = np.zeros(len(g), bool)
            several[1:] = g[1:] == g[:-1]
            several[:-1] |= several[1:]
            some = keep[several]
            if len(some):
                yield _row_batch(CONTEXT, gram[some], content[some], doc[some], text[some], start[some], size[some], at[some])

        for batch in batches:
            rows = tuple(batch.column(i).to_numpy() for i in range(7))
            if not len(rows[0]):
                continue
            if held and held[-1][0][-1] == rows[0][-1]:
                held.append(rows)
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            held.append(tuple(c[:cut] for c in rows))
            yield from close(tuple(np.concatenate(c) for c in zip(*held, strict=True)))
            held = [tuple(c[cut:] for c in rows)]
        if held:
            yield from close(tuple(np.concatenate(c) for c in zip(*held, strict=True)))

    return (found.filter(F.col("kind") == CONTEXT).select(*_NAMES[1:]).repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(run, CONTEXTS))


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted contexts with their bytes."""
    lists = wanted.groupBy("_id", "_text_hash").agg(F.collect_list(F.struct("gram", "start", "size", "at")).alias("known"))
    rows = _rows(docs).join(staged(lists, "wanted-contexts"), ["_id", "_text_hash"]).select("_id", "_text_hash", "text", "known")
    schema = "gram long, _id long, _text_hash long, start long, at int, bytes binary"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 500):
                out = []
                for doc, text_hash, text, known in zip(*(c.to_pylist() for c in batch.slice(i, 500).columns), strict=True):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    out += [(k["gram"], doc, text_hash, k["start"], k["at"], data[k["start"]:k["start"] + k["size"]]) for k in known]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 [c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], group: list[int], depth: int) -> tuple[list[int], list[int]]:
    """Order of a group that is tied to ``depth``, and the common prefix of each with the one before it.

    Inner nodes hold only the place where their strings part; a search looks at these bytes
    alone, then compares once with the leaf that it ends at.
    """
    # A node is a leaf [string numbers] or (place, {byte: node}); an ended string has byte -1.
    root: list | tuple = [group[0]]
    for new in group[1:]:
        text = strings[new]
        node = root
        while isinstance(node, tuple):
            place, children = node
            key = text[place] if place < len(text) else -1
            node = children[key] if key in children else next(iter(children.values()))
        other = strings[node[0]]
        common = common_prefix(text, other)
        if common == len(text) == len(other):
            node.append(new)
            continue
        # Down again to where the new string parts from its closest leaf.
        parent, taken, at = None, None, root
        while isinstance(at, tuple) and at[0] < common:
            key = text[at[0]] if at[0] < len(text) else -1
            parent, taken, at = at, key, at[1][key]
        key = text[common] if common < len(text) else -1
        if isinstance(at, tuple) and at[0] == common:
            at[1][key] = [new]
            continue
        branch = (common, {(other[common] if common < len(other) else -1): at, key: [new]})
        if parent is None:
            root = branch
        else:
            parent[1][taken] = branch
    order, common, todo, pending = [], [], [(root, 0)], 0
    while todo:
        node, before = todo.pop()
        if isinstance(node, tuple):
            keys = sorted(node[1])
            todo.extend((node[1][k], before if i == 0 else node[0]) for i, k in reversed(list(enumerate(keys))))
        else:
            for i, s in enumerate(node):
                order.append(s)
                common.append(before if i == 0 else len(strings[s]))
    return order, common


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Sorted order of strings, and the common prefix of each with the one before it (0 for the first)."""
    order: list[int] = []
    common: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) == 1:
            order.append(group[0])
            common.append(0)
        elif depth >= shallow:
            some, shared = blind_trie(strings, group, depth)
            order += some
            common += shared
        else:
            # Three ways by the next bytes, as one key.
            keys = {i: strings[i][depth:depth + 8] for i in group}
            pivot = keys[group[len(group) // 2]]
            less, same, more = [], [], []
            for i in group:
                (less if keys[i] < pivot else more if keys[i] > pivot else same).append(i)
            for part, deep in ((more, depth), (same, depth + 8 if len(pivot) == 8 else shallow), (less, depth)):
                if part:
                    todo.append((part, deep))
    for i in range(1, len(order)):
        if not common[i]:
            common[i] = common_prefix(strings[order[i - 1]], strings[order[i]])
    common[:1] = [0] * len(common[:1])
    return order, common


def _reaches(right: tuple[list[int], list[int]], before: tuple[list[int], list[int]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before and from the anchor that earlier strings cover, per string; 0 and 0 where none does.

    ``right`` and ``before``: sorted order and common prefixes of neighbours. For a window that begins
    b bytes before the anchor, runs of neighbours with b common bytes on the left and the rest on the
    right are classes; a string whose two classes an earlier string has, too, is covered by that window.
    All windows contain the anchor, so those of a string join to one run. No two strings are paired.
    """
    (order_r, common_r), (order_b, common_b) = (tuple(np.array(x) for x in y) for y in (right, before))
    n = len(order_r)
    back, ahead = np.zeros(n, np.int64), np.zeros(n, np.int64)
    begins = np.arange(max(0, length - int(common_r.max())), int(common_b.max()) + 1)
    step = max(1, WINDOW_CELLS // n)
    for low in range(0, len(begins), step):
        b = begins[low:low + step, None]
        classes = np.empty((2, len(b), n), np.int64)
        classes[0][:, order_b] = np.cumsum(common_b[None, :] < b, axis=1)
        classes[1][:, order_r] = np.cumsum(common_r[None, :] < length - b, axis=1)
        key = classes[0] * (n + 1) + classes[1]
        order = np.argsort(key, axis=1, kind="stable")
        key = np.take_along_axis(key, order, axis=1)
        met, place = np.nonzero(key[:, 1:] == key[:, :-1])
        at, b = order[met, place + 1], b[met, 0]
        np.maximum.at(back, at, b)
        np.maximum.at(ahead, at, length - b)
    return back, ahead


def covered(group: list[tuple], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """Covered runs (id, text hash, start, size) of the contexts of one anchor hash.

    ``group`` has (id, text hash, start, at, bytes) in the order of the documents.
    """
    out = []
    seen: dict[tuple[int, bytes], tuple] = {}
    left: list[tuple] = []
    for row in group:
        doc, text, start, at, content = row
        kept = seen.setdefault((at, content), row)
        if kept is row:
            left.append(row)
        elif kept[:3] != row[:3]:
            out.append((doc, text, start, len(content)))
    if len(left) > 1:
        back, ahead = _reaches(deep_shallow([r[4][r[3]:] for r in left]),
                               deep_shallow([r[4][:r[3]][::-1] for r in left]), length)
        for i in np.flatnonzero(ahead).tolist():
            doc, text, start, at, _ = left[i]
            out.append((doc, text, start + at - int(back[i]), int(back[i] + ahead[i])))
    return out


def repeats(found: DataFrame) -> DataFrame:
    """Covered runs among contexts that are gathered by anchor hash."""
    schema = "_id long, _text_hash long, start long, size long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def close() -> None:
            if len(held) > 1:
                out.extend(covered(sorted(held, key=lambda r: r[:3])))

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                              ["_id", "_text_hash", "start", "size"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("gram", "_id", "_text_hash", "start", "at", "bytes")]
            for gram, *row in zip(*columns, strict=True):
                if gram != key:
                    close()
                    key, held = gram, []
                    if len(out) > 20_000:
                        yield made()
                        out = []
                held.append(tuple(row))
        close()
        if out:
            yield made()

    return (found.select("gram", "_id", "_text_hash", "start", "at", "bytes").repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(run, schema))


def union_of(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal (begin, end) runs of the union of (start, size) runs."""
    out: list[list[int]] = []
    for start, size in sorted(runs):
        end = start + size
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def removal_runs(docs: DataFrame) -> DataFrame:
    """_id, _text_hash, known: maximal covered (start, size) runs of all documents that have any."""
    repeated = staged(repeated_anchors(docs), "repeated-anchors")
    found = contexts(docs, repeated)
    # What the batches covered and what the groups settle is written apart, the first pass is run for each.
    own = staged(found.filter(F.col("kind") == COVERED).select("_id", "_text_hash", "start", "size"), "own-runs")
    groups = staged(settled(found), "settled")
    wanted = groups.filter(F.col("kind") == CONTEXT).select("gram", "_id", "_text_hash", "start", "size", "at")
    runs = (own.unionByName(groups.filter(F.col("kind") == COVERED).select("_id", "_text_hash", "start", "size"))
            .unionByName(repeats(fetched(docs, wanted))))
    lists = runs.groupBy("_id", "_text_hash").agg(F.collect_list(F.struct("start", "size")).alias("runs"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
        for batch in batches:
            joined = [[{"start": a, "size": b - a} for a, b in union_of([(r["start"], r["size"]) for r in runs])]
                      for runs in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(joined, kind)], ["_id", "_text_hash", "known"])

    return staged(lists.mapInArrow(join, "_id long, _text_hash long, known array<struct<start: long, size: long>>"), "removal-runs")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                gone = [(r["start"], r["start"] + r["size"]) for r in runs or ()]
                kept, at = hashlib.sha256(), 0
                for a, b in gone:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out.append((len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                [c.split()[0] for c in schema.split(", ")])

    whole = docs.select(*_row_key(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (whole.join(removal_runs(docs), ["_id", "_text_hash"], "left").select("doc_id", "text", "known")
            .mapInArrow(run, schema))
