"""Word sequences that occur earlier in the corpus, found by FM-indexes of shards."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.joins import join_back
from tapeline.llm.common import fresh, rows_per_batch, stage, with_key

WINDOW = 20
GRAM = 6
SHARD_WORDS = 1 << 19
CROWD_WORDS = SHARD_WORDS // 4  # an anchor with more words in its different segments fills shards by window
BLOCK_SEGMENTS = 1 << 21
BLOCK_WORDS = 1 << 21
#: a gram is common in COMMON_DOCS documents and one in COMMON_SHARE; it decides only where segments are cut
COMMON_DOCS = 8
COMMON_SHARE = 512
COMMON_GRAMS = 1 << 20  # at most so many, 8 MB, are broadcast: those in most documents
BLOCK_GRAMS = 1 << 21
RESULTS = ("n_words", "n_removed")

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().split()  # at ASCII white space alone
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    found = np.zeros(n, dtype=np.uint64)
    for at in range(size):
        found = found * np.uint64(_ODD) + words[at : at + n]
    return mixed(found)


def _run_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each given run of words, whatever its length."""
    powers, back = np.ones((2, len(words) + 1), dtype=np.uint64)
    powers[1:], back[1:] = _ODD, _INVERSE
    powers, back = np.cumprod(powers), np.cumprod(back)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(mixed(words) * powers[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def segments(words: np.ndarray, common: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(anchor, content, check, start, windows) of runs of windows that share an anchor.

    The anchor of a window is its gram with the least hash, rare grams before those in
    ``common``, the first of equals. Equal windows thus have equal anchors at equal
    places, wherever they are; ``content`` and ``check`` are two hashes of all words of the run.
    """
    size = min(GRAM, window)
    if len(words) < window:
        return (np.empty(0, np.uint64),) * 3 + (np.empty(0, np.int64),) * 2
    grams = gram_hashes(words, size)
    order = grams >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
        order = order | ((common[at] == grams).astype(np.uint64) << np.uint64(63))
    views = sliding_window_view(order, window - size + 1)
    anchors = views.argmin(axis=1) + np.arange(len(views))
    first = np.flatnonzero(np.diff(anchors, prepend=-1))
    count = np.diff(np.append(first, len(anchors)))
    ends = first + count + window - 1
    return grams[anchors[first]], _run_hashes(words, first, ends), _run_hashes(mixed(~words), first, ends), first, count


class WaveletMatrix:
    """Ranks of symbols in a sequence, from a bit vector a level with counts a word."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in reversed(range(bits)):
            ones = (symbols >> level) & 1
            octets = np.packbits(ones.astype(np.uint8), bitorder="little")
            words = np.zeros(len(octets) // 8 + 1, dtype="<u8")
            words.view(np.uint8)[: len(octets)] = octets
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))
            self.levels.append((level, words, before, len(symbols) - int(ones.sum())))
            symbols = np.concatenate((symbols[ones == 0], symbols[ones == 1]))

    def places(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where each symbol's run, with those before position ``at``, ends in the last order."""
        for level, words, before, zeros in self.levels:
            word = at >> 6
            low = words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = before[word] + np.bitwise_count(low)
            at = np.where((symbols >> level) & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """A Burrows-Wheeler transform of segments in a wavelet matrix.

    Segments are arrays of word numbers from 1. Each ends in a mark of its own, so all
    suffixes differ within a segment's length and sorting takes few doubling rounds.
    Marks are one symbol, 0, in the transform: they are never searched.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        n = len(words) + len(lengths)
        is_mark = np.zeros(n, dtype=bool)
        is_mark[np.cumsum(lengths + 1) - 1] = True
        text = np.zeros(n, dtype=np.int64)
        text[~is_mark] = words
        rank = np.where(is_mark, np.cumsum(is_mark) - 1, text + len(lengths))
        _, rank = np.unique(rank, return_inverse=True)
        step = 1
        while True:
            after = np.concatenate((rank[step:] + 1, np.zeros(min(step, n), dtype=rank.dtype)))
            order = np.lexsort((after, rank))
            changed = (np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0)
            rank[order] = np.concatenate(([0], np.cumsum(changed)))
            if rank[order[-1]] == n - 1:
                break
            step *= 2
        self.n = n
        before = text[order - 1]  # the suffix at 0 follows the last mark
        bits = max(1, int(text.max()).bit_length())
        self.matrix = WaveletMatrix(before, bits)
        everything = np.arange(int(text.max()) + 1)
        self.base = self.matrix.places(everything, np.zeros_like(everything))
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text))[:-1]))

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of patterns with one more symbol before them."""
        shift = self.less[symbols] - self.base[symbols]
        return self.matrix.places(symbols, low) + shift, self.matrix.places(symbols, high) + shift

    def repeated(self, words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(which of the windows at ``starts`` of the streamed ``words`` occur twice, interval).

        Backward search from the last word of each window; a window leaves once no
        other place matches it, as its matching statistic is then below ``window``.
        """
        alive = np.arange(len(starts))
        low = np.zeros(len(starts), dtype=np.int64)
        high = np.full(len(starts), self.n, dtype=np.int64)
        for back in range(window - 1, -1, -1):
            low, high = self.extend(words[starts[alive] + back], low, high)
            more = high - low > 1
            alive, low, high = alive[more], low[more], high[more]
        return alive, low


def later_windows(contents: list[np.ndarray], keys: np.ndarray, at: np.ndarray, window: int):
    """(key, start) of windows of the segments that occur earlier among them.

    ``contents`` are word hashes; a segment stands in document ``keys`` at word ``at``.
    All segments are indexed, then streamed through the index.
    """
    lengths = np.array([len(c) for c in contents])
    _, words = np.unique(np.concatenate(contents), return_inverse=True)
    words = words + 1
    counts = lengths - window + 1
    owner = np.repeat(np.arange(len(contents)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (np.cumsum(lengths) - lengths)[owner] + within
    found, interval = FMIndex(words, lengths).repeated(words, starts, window)
    keys, at = keys[owner[found]], at[owner[found]] + within[found]
    order = np.lexsort((at, keys, interval))
    later = np.diff(interval[order], prepend=-1) == 0
    return keys[order][later], at[order][later]


def _later_copies(columns: list[np.ndarray]) -> np.ndarray:
    """Which rows (anchor, content, check, key, start) repeat the hashes of an earlier one."""
    anchor, content, check, key, start = columns
    order = np.lexsort((start, key, content, anchor))
    same = np.ones(len(order) - 1, dtype=bool)
    for hashes in (anchor, content, check):
        same &= hashes[order][1:] == hashes[order][:-1]
    later = np.zeros(len(order), dtype=bool)
    later[order[1:]] = same
    return later


def _common_grams(keyed: DataFrame, text: str) -> np.ndarray:
    """Hashes of grams that many documents share, sorted.

    Anchors avoid them, so that a passage in very many documents does not become the
    anchor of windows which also hold the different words around it. All documents
    are counted, a block of about BLOCK_GRAMS grams at a time; a block hands on the
    grams that several of its documents share, so few are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.append(np.unique(gram_hashes(word_hashes(value), GRAM)))
                size += len(held[-1])
            if size >= BLOCK_GRAMS:
                yield _shared_grams(held)
                held, size = [], 0
        if held:
            yield _shared_grams(held)

    grams = keyed.select(text).mapInArrow(run, "gram long, docs long")
    grams = grams.groupBy("gram").agg(F.sum("docs").alias("docs"))
    common = grams.filter(F.col("docs") >= max(COMMON_DOCS, keyed.count() / COMMON_SHARE))
    common = common.orderBy(F.desc("docs"), "gram").limit(COMMON_GRAMS).select("gram")
    return np.sort(common.toPandas()["gram"].to_numpy(dtype=np.int64).view(np.uint64))


def _shared_grams(held: list[np.ndarray]) -> pa.RecordBatch:
    """The grams of several documents of a block, and at least of one in 2 * COMMON_SHARE."""
    grams, docs = np.unique(np.concatenate(held), return_counts=True)
    shared = docs >= max(2, len(held) / (2 * COMMON_SHARE))
    columns = [pa.array(grams[shared].view(np.int64)), pa.array(docs[shared].astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["gram", "docs"])


_OCCURRENCE = "anchor long, content long, check long, key long, start long, windows int, later boolean"


def _occurrences(keyed: DataFrame, key: str, text: str, common: np.ndarray, window: int) -> DataFrame:
    """The segments of all documents.

    Of those with equal content in a task only the first goes on as an occurrence. The
    others are ``later`` already; they get an anchor of their own, which spreads them.
    """
    grams = keyed.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                anchor, content, check, start, windows = segments(word_hashes(value), grams.value, window)
                if len(anchor):
                    held.append((anchor, content, check, np.full(len(anchor), doc_key, np.int64), start, windows))
                    size += len(anchor)
            if size >= BLOCK_SEGMENTS:
                yield _collapsed(held)
                held, size = [], 0
        if held:
            yield _collapsed(held)

    return keyed.select(key, text).mapInArrow(run, _OCCURRENCE)


def _collapsed(held: list[tuple]) -> pa.RecordBatch:
    anchor, content, check, key, start, windows = (np.concatenate(c) for c in zip(*held, strict=True))
    later = _later_copies([anchor, content, check, key, start])
    anchor = np.where(later, _own(key, start), anchor)
    columns = [anchor.view(np.int64), content.view(np.int64), check.view(np.int64), key, start]
    columns += [windows.astype(np.int32), later]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _names(_OCCURRENCE))


def _own(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A value for each place, to spread rows by."""
    return mixed(mixed(key.view(np.uint64)) + start.astype(np.uint64))


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _ranked(occurrences: DataFrame) -> DataFrame:
    """Segments with ``later``, whether an equal one comes earlier; those have no anchor.

    Equal segments meet by both hashes of their words, and at most one of a block of
    segments is there, so no anchor brings all its segments into one task.
    """
    copies = Window.partitionBy("anchor", "content", "check").orderBy("key", "start")
    later = F.col("later") | (F.row_number().over(copies) > 1)
    rows = occurrences.withColumn("later", later)
    return rows.select(F.when(~F.col("later"), F.col("anchor")).alias("anchor"), "key", "start", "windows", "later")


def _differing(ranked: DataFrame, window: int) -> DataFrame:
    """First segments whose anchor has others, with ``crowded``: it has more than CROWD_WORDS words.

    Counts of an anchor are made in parts, and joined back so that a hot one can be split.
    """
    firsts = ranked.filter("not later").select("anchor", "key", "start", "windows")
    words = F.sum(F.col("windows").cast("long") + (window - 1))
    counts = firsts.groupBy("anchor").agg(F.count("*").alias("different"), words.alias("words"))
    shared = counts.filter("different > 1").select("anchor", (F.col("words") > CROWD_WORDS).alias("crowded"))
    return join_back(firsts, shared, ["anchor"], "inner")


_CONTENT = "shard long, key long, start long, words binary"


def _contents(
    keyed: DataFrame, wanted: DataFrame, key: str, text: str, shards: tuple[int, int], window: int
) -> DataFrame:
    """The words of wanted segments, by shard.

    Segments of crowded anchors are cut into their windows, which go to the shard that
    their own words say. Of equal windows in a block only the first has its words.
    """
    names = keyed.columns
    at_key, at_text = names.index(key), names.index(text)
    light, heavy = shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowd: list[tuple[int, int, np.ndarray]] = []
        size = 0
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            rows = (batch.column(i).to_pylist() for i in (at_key, at_text, len(names)))
            for doc_key, value, wants in zip(*rows, strict=True):
                words = word_hashes(value)
                for want in wants:
                    start, end = want["start"], want["start"] + want["windows"] + window - 1
                    if want["crowded"]:
                        crowd.append((doc_key, start, words[start:end].copy()))
                        size += end - start
                        if size >= BLOCK_WORDS:
                            yield from _windows(crowd, light, heavy, window)
                            crowd, size = [], 0
                        continue
                    row = (want["anchor"] % light, doc_key, start, words[start:end].tobytes())
                    for column, item in zip(columns, row, strict=True):
                        column.append(item)
            yield _content_batch(*columns)
        if crowd:
            yield from _windows(crowd, light, heavy, window)

    rows = keyed.join(wanted, key, "left").filter("wanted is not null")
    return rows.select(*names, "wanted").mapInArrow(run, _CONTENT)


def _content_batch(shard, key, start, words: list) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in (shard, key, start)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.binary())], _names(_CONTENT))


def _windows(crowd: list[tuple], light: int, heavy: int, window: int) -> Iterator[pa.RecordBatch]:
    """Each window of the segments (key, start, words) of a block, for the shards after the first ``light``."""
    counts = np.array([len(words) - window + 1 for _, _, words in crowd])
    owner = np.repeat(np.arange(len(crowd)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    key = np.array([c[0] for c in crowd], dtype=np.int64)[owner]
    start = np.array([c[1] for c in crowd], dtype=np.int64)[owner] + within
    first, second = (
        np.concatenate([gram_hashes(scrambled(words), window) for _, _, words in crowd])
        for scrambled in (mixed, lambda words: mixed(~words))
    )
    later = _later_copies([first, second, second, key, start])
    shard = np.where(later, _own(key, start), first) % np.uint64(heavy)
    shard = shard.astype(np.int64) + light
    step = 1 << 16
    for at in range(0, len(key), step):
        part = slice(at, at + step)
        places = zip(owner[part].tolist(), within[part].tolist(), later[part].tolist(), strict=True)
        words = [None if known else crowd[i][2][w : w + window].tobytes() for i, w, known in places]
        yield _content_batch(shard[part], key[part], start[part], words)


def _search_shard(window: int):
    def run(rows: pa.Table) -> pa.Table:
        key, start = (rows.column(c).to_numpy() for c in ("key", "start"))
        contents = rows.column("words").to_pylist()
        known = np.array([words is None for words in contents])
        parts = [(key[known], start[known])]
        words = [np.frombuffer(w, "<u8") for w in contents if w is not None]
        if words:
            parts.append(later_windows(words, key[~known], start[~known], window))
        keys, starts = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.table({"key": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64())})

    return run


def repeated_windows(keyed: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """(key, start, windows): runs of windows that also start earlier, in order of key and start.

    Shards hold what can match, so that no document is streamed through all of them.
    Every window goes where its anchor says, in runs that share an anchor. Runs whose
    anchor occurs once can't match. Equal runs, by 128 bits of hashes, are copies of the first
    of them. What differs but shares an anchor is indexed and searched, a shard of about
    SHARD_WORDS words at a time. Runs of an anchor that would overfill a shard are cut
    into their windows, which are spread by their own words and searched in the same way.
    """
    spark = keyed.sparkSession
    rows_per_batch(spark)
    common = _common_grams(keyed, text)
    ranked = stage(_ranked(_occurrences(keyed, key, text, common, window)), "segments")
    wanted = stage(_differing(ranked, window), "differing")
    sizes = wanted.agg(
        F.sum(F.when(~F.col("crowded"), F.col("windows").cast("long") + (window - 1))),
        F.sum(F.when(F.col("crowded"), F.col("windows").cast("long") * window)),
    ).first()
    shards = tuple(max(1, -(-(size or 0) // SHARD_WORDS)) for size in sizes)
    row = F.struct("anchor", "start", "windows", "crowded")
    wanted = wanted.groupBy(F.col("key").alias(key)).agg(F.collect_list(row).alias("wanted"))
    contents = _contents(keyed, wanted, key, text, shards, window)
    searched = contents.groupBy("shard").applyInArrow(_search_shard(window), "key long, start long")
    known = ranked.filter("later").select("key", "start", "windows")
    return known.unionByName(searched.withColumn("windows", F.lit(1)))


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    keep_layout: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without words covered by windows that start earlier, and n_words, n_removed.

    A window is ``window`` consecutive words of a document; it starts earlier in a
    document with a smaller id, or before in the same one. Windows are judged on the
    texts as given. ``text`` becomes the kept words joined by one space, or, with
    ``keep_layout``, the source without the removed words and the space before each.
    Null texts have no words and stay null; rows that share an id are documents in order of
    text, and null ids come last. Columns named n_words or n_removed are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in RESULTS])
    key, spans = fresh(docs, "_key"), fresh(docs, "_spans")
    keyed = with_key(docs, key, id_col, text_col)
    keyed = keyed.filter(F.col(key).isNotNull())
    cover = F.struct("start", (F.col("start") + F.col("windows") + (window - 1)).alias("end"))
    removed = repeated_windows(keyed, key, text_col, window)
    removed = removed.groupBy(F.col("key").alias(key)).agg(F.collect_list(cover).alias(spans))
    names = keyed.columns
    at_text = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at_text).to_pylist()
            done = [kept(t, s, keep_layout) for t, s in zip(texts, batch.column(len(names)).to_pylist(), strict=True)]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at_text] = pa.array([d[0] for d in done], pa.string())
            counts = [pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([*columns, *counts], [*names, *RESULTS])

    schema = keyed.schema
    for name in RESULTS:
        schema = schema.add(name, "long")
    rows = keyed.join(removed, key, "left").select(*names, spans)
    return rows.mapInArrow(run, schema).drop(key)


def kept(text: str | None, spans: list[dict] | None, keep_layout: bool) -> tuple[str | None, int, int]:
    """(what stays of a text, its words, words removed)."""
    if text is None:
        return None, 0, 0
    source = text.encode()
    words = source.split()
    if not spans:
        return (text if keep_layout else b" ".join(words).decode()), len(words), 0
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, [s["start"] for s in spans], 1)
    np.add.at(edges, [s["end"] for s in spans], -1)
    gone = np.cumsum(edges[:-1]) > 0
    if not keep_layout:
        stay = b" ".join(w for w, out in zip(words, gone.tolist(), strict=True) if not out)
        return stay.decode(), len(words), int(gone.sum())
    parts, at = [], 0
    for word, out in zip(words, gone.tolist(), strict=True):
        end = source.index(word, at) + len(word)
        if not out:
            parts.append(source[at:end])
        at = end
    return b"".join([*parts, source[at:]]).decode(), len(words), int(gone.sum())
