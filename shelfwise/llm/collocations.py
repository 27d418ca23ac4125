"""Collocations by relational mining (SETM): occurrence relations that grow by one word a level.

Texts (A-Z in lower case) are cut into pieces at ``. , ; : ! ?`` and line ends and pieces into words
at spaces and tabs. The relation of a level holds every occurrence of a phrase of so many words,
sorted by position. It is kept as rows of blocks: one language, ``BLOCK`` characters or so, the
positions and the phrase of each. Level k + 1 is the merge join of level k with itself on adjacent
positions of a piece: two phrases that overlap in all but one word. Its phrases are counted in the
block first and then by phrase over all blocks; the relation keeps only occurrences of phrases that
are frequent (a semi-join) and is written to the shared folder before the next level reads it.

Inside a block phrases are exact numbers; between blocks they are their words. The semi-join uses a
bitmap of ``SCREEN_BITS`` bits, whatever the size of the corpus: it lets all frequent phrases pass
and some others, which the exact counts of the next level then drop, so it decides no result.

Null text is empty, a null language is ``und``. Rows are documents of their own, repeated ones too;
ids are not used. An empty table gives no rows. Ties in rank end with the phrase, so ranks are
unique. Texts longer than a block are cut between pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm import textvec
from shelfwise.session import staged

LEAST = 100
LONGEST = 5
TOP = 2000
NO_LANGUAGE = "und"
MARKS = ".,;:!?\n\x0b\x0c\r"
#: Characters of a block, about.
BLOCK = 1 << 21
#: 8 MB for each level; a power of two.
SCREEN_BITS = 1 << 26
#: Bits that meet in one row while a screen is put together.
CHUNK_BITS = 1 << 17
#: Phrases that a task holds before it adds them up, and occurrences whose phrases are added up by one task, about.
HELD_PHRASES = 1 << 20
PART_OCCURRENCES = 1 << 22

_MARK = re.compile(f"[{re.escape(MARKS)}]")
#: A-Z in lower case, marks as line ends.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A"):ord("Z") + 1] += 32
_PLAIN[[ord(c) for c in MARKS]] = 10
_RELATION = "lang string, words array<string>, phrases binary, positions binary, ids binary, n long"


def portions(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in lists of about ``BLOCK`` characters; a longer text is cut behind a mark."""
    held, size = [], 0
    for text in texts:
        begin = 0
        while begin < len(text):
            mark = _MARK.search(text, begin + BLOCK) if len(text) - begin > 2 * BLOCK else None
            end = mark.end() if mark else len(text)
            held.append(text[begin:end])
            size += end - begin
            begin = end
            if size >= BLOCK:
                yield held
                held, size = [], 0
    if held:
        yield held


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all slices in a row, and their n + 1 bounds."""
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes)], bounds


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def word_numbers(data: np.ndarray, found: textvec.Words) -> tuple[np.ndarray, np.ndarray]:
    """A number for each different word, by its bytes, and a first place of each."""
    _, first, number = np.unique(found.hashes, return_index=True, return_inverse=True)
    sizes = found.ends - found.starts
    place = first[number]
    same = bool((sizes == sizes[place]).all())
    if same:
        same = np.array_equal(gathered(data, found.starts, sizes)[0], gathered(data, found.starts[place], sizes)[0])
    if same:
        return number, first
    known: dict[bytes, int] = {}  # two words of one hash
    number = np.array([known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(found.starts, found.ends, strict=True)])
    return number, np.unique(number, return_index=True)[1]


@dataclass
class Occurrences:
    """Sorted positions, the phrase at each, and each phrase as a row of word numbers."""

    words: pa.Array
    phrases: np.ndarray
    positions: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Occurrences:
        """Every word of the texts; positions of two pieces never follow one another."""
        raw, bounds = textvec.packed(texts)
        data = _PLAIN[raw]
        found = textvec.words(data, bounds)
        number, first = word_numbers(data, found)
        ends = data == 10
        ends[bounds[1:-1][bounds[1:-1] < len(data)]] = True  # a text that begins with a word ends the piece before it
        piece = np.cumsum(ends)[found.starts] if len(found.starts) else found.starts
        positions = np.arange(len(piece)) + np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)
        words = strings(*gathered(data, found.starts[first], (found.ends - found.starts)[first]))
        # Numbers follow the order of the words, so that phrases come out sorted and are stored and shuffled small.
        order = pc.sort_indices(words)
        rank = np.empty(len(first), np.int64)
        rank[order.to_numpy()] = np.arange(len(first))
        return cls(words.take(order), np.arange(len(first))[:, None], positions, rank[number])

    @classmethod
    def read(cls, words: pa.Array, phrases: bytes, positions: bytes, ids: bytes) -> Occurrences:
        unpack = zstandard.ZstdDecompressor().decompress
        width = int.from_bytes(phrases[:4], "little")
        rows = np.frombuffer(unpack(phrases[4:]), "<i4").reshape(-1, width) if width > 1 else np.arange(len(words))[:, None]
        return cls(words, rows, np.cumsum(np.frombuffer(unpack(positions), "<i4"), dtype=np.int64),
                   np.frombuffer(unpack(ids), "<i4"))

    def written(self) -> tuple[bytes, bytes, bytes]:
        pack = zstandard.ZstdCompressor(level=1).compress
        width = self.phrases.shape[1]  # one word: the words in their order
        return (width.to_bytes(4, "little") + (pack(self.phrases.astype("<i4").tobytes()) if width > 1 else b""),
                pack(np.diff(self.positions, prepend=0).astype("<i4").tobytes()), pack(self.ids.astype("<i4").tobytes()))

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids, minlength=len(self.phrases))

    def joined(self) -> Occurrences:
        """The next level: phrases at a position and the one behind it."""
        met = np.flatnonzero(np.diff(self.positions) == 1)
        n = len(self.phrases)
        pairs, ids = np.unique(self.ids[met].astype(np.int64) * n + self.ids[met + 1], return_inverse=True)
        one, other = pairs // max(n, 1), pairs % max(n, 1)
        return Occurrences(self.words, np.concatenate([self.phrases[one], self.phrases[other, -1:]], axis=1), self.positions[met], ids)

    def hashes(self, lang: str) -> np.ndarray:
        data, bounds = textvec.packed(self.words)
        return phrase_hashes(textvec.words(data, bounds).hashes, self.phrases, lang)

    def semi_joined(self, screen: np.ndarray, lang: str) -> Occurrences:
        """The occurrences of phrases that pass the screen; words and phrases that are left."""
        place = self.hashes(lang) >> np.uint64(64 - (len(screen) * 8).bit_length() + 1)
        passed = (screen[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        at = passed[self.ids]
        phrases, ids = self.phrases[passed], (np.cumsum(passed) - 1)[self.ids[at]]
        used, flat = np.unique(phrases, return_inverse=True)
        return Occurrences(self.words.take(pa.array(used)), flat.reshape(phrases.shape), self.positions[at], ids)

    def texts(self) -> pa.Array:
        """Each phrase with a space between its words."""
        data, bounds = textvec.packed(self.words)
        sizes = np.diff(bounds)
        data = np.append(data, np.uint8(32))  # the space
        flat = self.phrases
        n, width = flat.shape
        starts, lengths = np.full((n, 2 * width - 1), len(data) - 1), np.ones((n, 2 * width - 1), np.int64)
        starts[:, ::2], lengths[:, ::2] = bounds[:-1][flat], sizes[flat]
        found, ends = gathered(data, starts.ravel(), lengths.ravel())
        return strings(found, ends[::2 * width - 1])


def phrase_hashes(hashes: np.ndarray, phrases: np.ndarray, lang: str) -> np.ndarray:
    """64 bits for each row of word numbers, from the hashes of the words and the language."""
    seed = int.from_bytes(lang.encode("utf-8", "surrogatepass")[:64], "little") * 0x9E3779B97F4A7C15 % (1 << 64)
    out = np.full(len(phrases), seed, np.uint64)
    for k in range(phrases.shape[1]):
        out = textvec.mix(out + hashes[phrases[:, k]])
    return out


def _rows(lang: list[str], found: list[Occurrences]) -> pa.RecordBatch:
    coded = [f.written() for f in found]
    sizes = np.concatenate([[0], np.cumsum([len(f.words) for f in found])])
    words = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.concat_arrays([f.words for f in found]))
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), words, *(pa.array(c, pa.binary()) for c in zip(*coded, strict=True)),
                                       pa.array([len(f.ids) for f in found], pa.int64())],
                                      ["lang", "words", "phrases", "positions", "ids", "n"])


def _read(batch: pa.RecordBatch) -> Iterator[tuple[str, Occurrences]]:
    for i in range(len(batch)):  # one block after the other, so that a worker holds one
        lang, words, *rest = (batch.column(c)[i] for c in range(5))
        yield lang.as_py(), Occurrences.read(words.values, *(x.as_py() for x in rest))


def word_occurrences(docs: DataFrame) -> DataFrame:
    """The relation of single words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0)
            for lang in pc.unique(langs):
                own = batch.column(1).filter(pc.equal(langs, lang))
                for some in portions(x.as_py() for x in own):
                    yield _rows([lang.as_py()], [Occurrences.of(some)])

    return docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, _RELATION)


def _kept(found: Occurrences, screen: np.ndarray | None, lang: str) -> Occurrences:
    return found if screen is None else found.semi_joined(screen, lang)


def _bits(sent: Broadcast | None) -> np.ndarray | None:
    return None if sent is None else np.frombuffer(sent.value, np.uint8)


def _bundles(held: list[tuple[str, pa.Array, np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    """The counts of some blocks added up, as one sorted and compressed row for each language and part."""
    pack, rows = zstandard.ZstdCompressor(level=1).compress, []
    for lang in dict.fromkeys(x[0] for x in held):
        own = [x for x in held if x[0] == lang]
        phrase, hashes, n = (pa.concat_arrays([x[1] for x in own]), *(np.concatenate([x[k] for x in own]) for k in (2, 3)))
        if len(own) > 1:
            table = pa.table({"phrase": phrase, "hash": hashes, "n": n}).group_by("phrase", use_threads=False).aggregate([("hash", "min"), ("n", "sum")])
            table = table.take(pc.sort_indices(table.column("phrase")))
            phrase, hashes, n = table.column("phrase").combine_chunks(), table.column("hash_min").to_numpy(), table.column("n_sum").to_numpy()
        part = (hashes % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        phrase, n = phrase.take(pa.array(order)), n[order]
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        data, bounds = textvec.packed(phrase)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            lo, hi = cuts[k], cuts[k + 1]
            rows.append((k, lang, pack(data[bounds[lo]:bounds[hi]].tobytes()), pack(np.diff(bounds[lo:hi + 1]).astype("<i4").tobytes()),
                         pack(n[lo:hi].astype("<i8").tobytes())))
    kinds = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["part", "lang", "phrases", "sizes", "counts"])


def counted(relation: DataFrame, screen: Broadcast | None, join: bool, least: int) -> DataFrame:
    """lang, phrase and f of the phrases of the relation, or of its join with itself, that are met ``least`` times
    or more; and for each task and language a row without phrase, whose f counts all occurrences.

    Phrases are added up in the task, dealt to parts by their hash and added up there. What goes between is sorted
    and compressed, a fourth of the size of the rows. The number of parts grows with the occurrences.
    """
    spark = relation.sparkSession
    many = relation.agg(F.sum("n")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-many // PART_OCCURRENCES))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, size = _bits(screen), [], 0
        for batch in batches:
            for lang, found in _read(batch):
                found = _kept(found, bits, lang)
                found = found.joined() if join else found
                held.append((lang, found.texts(), found.hashes(lang), found.counts()))
                size += len(found.phrases)
                if size >= HELD_PHRASES:
                    yield _bundles(held, parts)
                    held, size = [], 0
        if held:
            yield _bundles(held, parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        sums: dict[str, pa.Table] = {}
        new: dict[str, list[pa.Table]] = {}
        size = 0

        def merge() -> None:
            for lang, tables in new.items():
                held = [sums[lang]] if lang in sums else []
                sums[lang] = (pa.concat_tables([*held, *tables]).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
                              .rename_columns({"n_sum": "n"}).select(["phrase", "n"]))
            new.clear()

        for batch in batches:
            for i in range(len(batch)):
                lang, phrases, sizes, counts = (batch.column(c)[i].as_py() for c in range(1, 5))
                bounds = np.concatenate([[0], np.cumsum(np.frombuffer(unpack(sizes), "<i4"))])
                new.setdefault(lang, []).append(pa.table({"phrase": strings(np.frombuffer(unpack(phrases), np.uint8), bounds),
                                                          "n": np.frombuffer(unpack(counts), "<i8")}))
                size += len(bounds) - 1
                if size >= HELD_PHRASES:
                    merge()
                    size = 0
        merge()
        for lang, table in sums.items():
            n = table.column("n")
            table = table.filter(pc.greater_equal(n, least))
            for part in [pa.table({"phrase": pa.array([None], pa.string()), "n": pa.array([pc.sum(n).as_py()], pa.int64())}), table]:
                for some in part.to_batches(1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), *some.columns], ["lang", "phrase", "f"])

    bundles = relation.select("lang", "words", "phrases", "positions", "ids").mapInArrow(
        bundle, "part int, lang string, phrases binary, sizes binary, counts binary")
    return bundles.repartition(parts, "part").mapInArrow(add, "lang string, phrase string, f long")


def extended(relation: DataFrame, screen: Broadcast | None, after: Broadcast) -> DataFrame:
    """The next relation: joined with itself, then without phrases that ``after`` does not let pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, last = _bits(screen), _bits(after)
        for batch in batches:
            for lang, found in _read(batch):
                found = _kept(found, bits, lang).joined().semi_joined(last, lang)
                if len(found.ids):
                    yield _rows([lang], [found])

    return relation.select("lang", "words", "phrases", "positions", "ids").mapInArrow(run, _RELATION)


def screen_of(frequent: DataFrame, words: int, bits: int = SCREEN_BITS) -> Broadcast:
    """Bitmap of the frequent phrases of so many words. Its size is fixed; bits are put together by chunk."""
    chunk_bits = min(CHUNK_BITS, bits)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = textvec.words(*textvec.packed(batch.column(1)))
            phrases = np.arange(len(batch) * words).reshape(-1, words)
            lang, out = np.array(batch.column(0).to_pylist(), object), np.zeros(len(batch), np.uint64)
            for value in set(lang):
                mine = lang == value
                out[mine] = phrase_hashes(found.hashes, phrases[mine], value)
            out = np.unique(out >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out // chunk_bits, pa.int64()), pa.array(out % chunk_bits, pa.int64())], ["chunk", "bit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = []
            for some in batch.column(1):
                flags = np.zeros(chunk_bits, bool)
                flags[some.values.to_numpy()] = True
                coded.append(zstandard.compress(np.packbits(flags, bitorder="little").tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded, pa.binary())], ["chunk", "bits"])

    rows = (frequent.select("lang", "phrase").mapInArrow(places, "chunk long, bit long").distinct().groupBy("chunk")
            .agg(F.collect_set("bit").alias("bits")).mapInArrow(pack, "chunk long, bits binary").toArrow())
    out = np.zeros(bits // 8, np.uint8)
    for chunk, coded in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        out[chunk * chunk_bits // 8:(chunk + 1) * chunk_bits // 8] = np.frombuffer(zstandard.decompress(coded), np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(out.tobytes())


def levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = SCREEN_BITS) -> tuple[DataFrame, list[DataFrame]]:
    """lang and n (words), and for each number of words lang, phrase, f of the phrases met ``least`` times or more."""
    relation = staged(word_occurrences(docs), "occurrences-1")
    words = staged(counted(relation, None, False, least), "frequent-1")
    total = words.filter("phrase is null").groupBy("lang").agg(F.sum("f").alias("n"))
    found = [words.filter("phrase is not null")]
    screen = screen_of(found[0], 1, bits) if longest > 1 else None
    for k in range(2, longest + 1):
        found.append(staged(counted(relation, screen, True, least).filter("phrase is not null"), f"frequent-{k}"))
        if k < longest:
            after = screen_of(found[-1], k, bits)
            # From here on the relation holds only what the screen lets pass.
            relation = staged(extended(relation, screen, after), f"occurrences-{k}")
            for sent in (screen, after):  # what is stored needs no screen again
                if sent is not None:
                    sent.unpersist()
            screen = None
    return total, found


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, bits: int = SCREEN_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``longest`` words.

    The score of a cut into two parts met l and r times is floor(1000 a n / (l r)); a phrase takes its lowest
    cut, ties to the shortest first part. A phrase goes if one more word on either side leaves its count as it is:
    what is inside a longer phrase of equal count is inside one that is longer by one word, too.
    """
    total, found = levels(docs, least, longest, bits)
    sized = [f.withColumn("words", F.lit(k)) for k, f in enumerate(found, 1)]
    every = reduce(DataFrame.unionByName, sized)
    phrases = every.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    inner = F.transform(F.array(F.lit(1), F.lit(2)), lambda at: F.array_join(F.slice("w", at, F.col("words") - 1), " "))
    # A phrase has many longer ones around it; only the most frequent counts, and no more than its own count.
    around = (phrases.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("b"))
              .groupBy("lang", "phrase").agg(F.max("b").alias("b")))
    kept = phrases.join(around, ["lang", "phrase"], "left").filter(F.col("b").isNull() | (F.col("b") < F.col("a")))
    cuts = kept.select("lang", "phrase", "a", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("one"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("other"))
    one = every.select("lang", F.col("phrase").alias("one"), F.col("f").alias("l"))
    other = every.select("lang", F.col("phrase").alias("other"), F.col("f").alias("r"))
    wide = "decimal(19,0)"
    score = F.expr(f"(cast(1000 as decimal(4,0)) * (cast(a as {wide}) * cast(n as {wide}))) div (cast(l as {wide}) * cast(r as {wide}))")
    scored = staged(cuts.join(one, ["lang", "one"]).join(other, ["lang", "other"]).join(staged(total, "word-totals"), "lang")
                    .withColumn("score", score).groupBy("lang", "phrase")
                    .agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("s")).select("lang", "phrase", "s.*"), "scored")
    # Counts by steps of the score tell which rows can be among the first, before a language meets in one task.
    step = F.floor(64 * F.log2(F.col("score") + 1)).alias("step")
    higher = Window.partitionBy("lang").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    steps = (scored.groupBy("lang", step).agg(F.count(F.lit(1)).alias("m")).withColumn("before", F.coalesce(F.sum("m").over(higher), F.lit(0)))
             .filter(F.col("before") < top).groupBy("lang").agg(F.min("step").alias("least")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (scored.join(staged(steps, "least-scores"), "lang").filter(step >= F.col("least"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
