"""Suffix-array deduplication: all repeated strings of SPAN bytes or more (operator 3).

A suffix array of the whole corpus can't be one sort, so the corpus is first cut into
buckets that no repeat crosses. Every window of SPAN bytes belongs to its minimizer: of the
GRAM-byte strings in it, the one with the least hash (ties: leftmost). Equal windows have
equal minimizers at equal places, so the windows of one minimizer (an owned segment, 76
windows on average) only repeat under the same gram.

1. Grams that occur once are dropped. Equal owned segments are one class: a class with two
   members repeats whole, and only one member goes on as partner of the other classes.
2. In each bucket of a gram with several classes an enhanced suffix array is built: the sorted
   suffixes that start a window, their longest common prefixes, and a stack scan over these
   that yields the common-prefix intervals. Intervals of SPAN or more whose members differ in
   the byte to the left (left-extension diversity; a segment's start counts as different) are
   the maximal repeats, each with all its occurrences; these cover the repeated windows.
3. A bucket of more than LIMIT classes is not gathered. Its segments are cut into blocks of
   BLOCK windows, and buckets made by the bytes that all windows of a block share; blocks equal
   as a whole are one class again. What is still over LIMIT is decided window by window, by
   counting digests. Nothing is dropped, and no bucket's size follows a hot string.

Per text, covered bytes are joined back by (id, hash of the text); texts without any take no
part in the join (a filter of FLAGS flags, so bounded, lets the others through).

Defined results: a null or empty text, or one of under SPAN bytes, keeps all its bytes;
overlapping occurrences in one text count; equal rows are copies of each other, and of rows of
equal id and text one is cut for all, however many there are; a very long text is searched in
pieces; an empty table gives an empty result.
"""

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import bound_batches, materialize, quoted, scope
from .textbytes import _BASE, _BASE_INV, BLOCK_BYTES, blocks, mix, powers, releasing, text_buffer

SPAN = 200
GRAM = 50
REACH = SPAN - GRAM  # a window's grams start at 0 .. REACH
LIMIT = 256
#: Windows of the buckets that are searched at once.
WINDOWS = 1 << 18
BLOCK = 16
#: Bytes of texts whose segments are found at once.
NEAR_BYTES = 1 << 16
#: Segments that are cut out of texts at once.
TEXTS = 20_000
FLAGS = 1 << 21
_LOW = np.uint64((1 << 24) - 1)
_SALT = np.uint64(0xD6E8FEB86659FD93)


class Hasher:
    """Hashes of any stretches of a piece of text, of eight bytes or more.

    Each place counts by a mix of the eight bytes from it on, in a polynomial of the places that lie in the stretch
    with all eight. Bytes alone in the polynomial would collide by structure, such as Thue-Morse words. These hashes choose
    grams and buckets; what is taken to be equal has equal digests.
    """

    def __init__(self, data: np.ndarray):
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        eight = np.ndarray((len(data),), "<u8", padded, 0, (1,))
        self.total = np.zeros(len(data) + 1, np.uint64)
        term = mix(eight + _BASE)
        term *= powers(_BASE, len(data))
        np.cumsum(term, out=self.total[1:])
        self.inverse = powers(_BASE_INV, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end - 7] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64) * _SALT)

    def each(self, width: int) -> np.ndarray:
        """of(i, i + width) for every i."""
        n = len(self.total) - width
        h = self.total[width - 7 : width - 7 + n] - self.total[:n]
        h *= self.inverse[:n]
        h += np.uint64(width * int(_SALT) % (1 << 64))
        return mix(h)


#: For each number that digests() takes, the state that has taken it in.
_SALTED = [hashlib.blake2b(digest_size=8, salt=struct.pack("<q", x)) for x in range(256)]


def digests(text: bytes, start: list[int], end: list[int], extra: list[int]) -> np.ndarray:
    """Digests of stretches of text, each with a number (below 256) of its own. A class is known by its gram and a digest, which is 64 bits of BLAKE2b."""
    out = []
    for a, b, x in zip(start, end, extra, strict=True):
        digest = _SALTED[x].copy()
        digest.update(text[a:b])
        out.append(digest.digest())
    return np.frombuffer(b"".join(out), "<u8")


def _window_min(key: np.ndarray, width: int) -> np.ndarray:
    """Least of key[i : i + width] for every i, by doubling widths."""
    have = 1
    while have < width:
        step = min(have, width - have)
        key, have = np.minimum(key[:-step], key[step:]), have + step
    return key


def pieces(offsets: np.ndarray):
    """(first row, last row + 1, byte from, byte to): blocks of rows, small enough that the arrays on their places stay in a core's cache, and overlapping pieces of longer rows."""
    for a, b in blocks(offsets, NEAR_BYTES):
        start, end = int(offsets[a]), int(offsets[b])
        while end - start > 2 * BLOCK_BYTES:
            yield a, b, start, start + BLOCK_BYTES + SPAN - 1
            start += BLOCK_BYTES
        yield a, b, start, end


def segments(data: np.ndarray, cuts: np.ndarray):
    """(gram hash, segment hash, gram's place, windows before it, windows' last before it) of the owned segments of a piece; cuts: text bounds in it."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    if len(data) < SPAN:
        return none
    n = len(data) - SPAN + 1
    gram = Hasher(data).each(GRAM)
    owner = gram & ~_LOW
    owner |= np.arange(len(gram), dtype=np.uint64)
    owner = _window_min(owner, REACH + 1)
    inside = np.ones(n, bool)  # windows that lie in one text
    for cut in np.unique(cuts[1:-1]).tolist():
        inside[max(cut - SPAN + 1, 0) : cut] = False
    new = np.ones(n, bool)
    np.not_equal(owner[1:], owner[:-1], out=new[1:])
    new[1:] |= ~inside[:-1]
    last = np.ones(n, bool)
    last[:-1] = new[1:] | ~inside[1:]
    lo, hi = np.flatnonzero(new & inside), np.flatnonzero(last & inside)
    if not len(lo):
        return none
    j = (owner[lo] & _LOW).astype(np.int64)
    whole = digests(data.tobytes(), lo.tolist(), (hi + SPAN).tolist(), (j - lo).tolist())
    return gram[j], whole, j, j - lo, j - hi


def _owned(docs: DataFrame) -> DataFrame:
    """gram, seg, kid, th, at: place of the gram in its text << 16 | windows before << 8 | last window before."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for a, b, start, end in pieces(offsets):
                cuts = np.clip(offsets[a : b + 1], start, end) - start
                gram, seg, j, before, last = segments(data[start:end], cuts)
                if not len(gram):
                    continue
                row = a + np.searchsorted(cuts[1:], j - before, "right")
                at = (j + start - offsets[row]) << 16 | before << 8 | last
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(seg.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at)], names=["gram", "seg", "kid", "th", "at"])

    return docs.select("kid", "th", "text").mapInArrow(run, "gram long, seg long, kid long, th long, at long")


def _flagged(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows (kid, th, text) that may be among keys, equal ones once: a filter of bounded size, so that most others skip the shuffle."""
    slot = F.pmod(F.xxhash64("kid", "th"), F.lit(FLAGS))
    flags = np.zeros(FLAGS, bool)
    flags[keys.select(slot.alias("s")).distinct().toArrow()["s"].to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(flags))

    def run(batches):
        on = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(on[batch.column(3).to_numpy()])).select(["kid", "th", "text"])

    return docs.withColumn("slot", slot).select("kid", "th", "text", "slot").mapInArrow(run, "kid long, th long, text string").dropDuplicates(["kid", "th"])


def _sorted(text: np.ndarray, start: np.ndarray, length: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix of each with the next) of stretches of text, those of several buckets apart from each other; text goes on for the longest length."""
    width = int(length.max())
    table = text[start[:, None] + np.arange(width)]
    table[np.arange(width) >= length[:, None]] = 0
    order = np.lexsort((length, table.view(f"S{width}").ravel(), bucket))
    table, length, bucket = table[order], length[order], bucket[order]
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    common = np.minimum(common, np.minimum(length[1:], length[:-1]))
    common[bucket[1:] != bucket[:-1]] = 0
    return order, np.r_[common, 0]


def suffix_array(data: np.ndarray, size: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, ...]:
    """(member, offset, common prefix with the next, left byte) of the sorted suffixes that start a window; -1: a member's start.

    Members are stretches of data in a row, of given sizes; those of several buckets are sorted at once, apart from each other.
    """
    text = np.concatenate([data, np.zeros(int(size.max()), np.uint8)])
    first = np.cumsum(size) - size
    windows = size - SPAN + 1
    member = np.repeat(np.arange(len(size)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    order, common = _sorted(text, first[member] + offset, size[member] - offset, bucket[member])
    member, offset = member[order], offset[order]
    return member, offset, common, _left(text, first, member, offset)


def _left(text: np.ndarray, first: np.ndarray, member: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return np.where(offset > 0, text[first[member] + offset - 1].astype(np.int64), -1)


def anchored_suffix_array(data: np.ndarray, size: np.ndarray, bucket: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """What suffix_array() gives, but sorted by distance before the gram first, and without suffixes that share no window with another.

    place: where in a member its gram starts, in its first window and its last. Equal windows start at equal distances before the gram.
    So only the suffixes from the grams on are sorted as texts, one for each member; the order at each further distance is induced from the
    one before: by the byte that is new on the left, and by the order so far among equal bytes. A common prefix grows by that
    byte, or is the least one of those that lay between. What is shared short of the gram's end at one distance
    is short of a window at all further ones: such members part, and those without a partner go.
    """
    text = np.concatenate([data, np.zeros(int(size.max()), np.uint8)])
    first = np.cumsum(size) - size
    gram = first + place
    order, common = _sorted(text, gram, size - place, bucket)
    found = []
    for distance in range(REACH + 1):
        close = common >= GRAM + distance  # else no window of these two at any distance from here on
        close[-1:] = False
        partner = close.copy()
        partner[1:] |= close[:-1]
        order, common, close = order[partner], common[partner], close[partner]
        if not len(order):
            break
        deep = common >= SPAN
        deep[1:] |= common[:-1] >= SPAN
        member = order[deep]
        found.append((member, place[member] - distance, common[deep]))
        # one byte to the left, for members that have it
        at = np.flatnonzero(place[order] > distance)
        group = np.cumsum(np.r_[0, ~close[:-1]])
        key = group[at] << 8 | text[gram[order[at]] - distance - 1]
        if (key[1:] < key[:-1]).any():
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
        same = np.flatnonzero(key[1:] == key[:-1])  # these lie in the order so far
        after = np.zeros(len(at), np.int64)
        after[same] = common[at[same]]
        far = same[at[same + 1] > at[same] + 1]
        if len(far):
            after[far] = np.minimum.reduceat(common, np.stack([at[far], at[far + 1]], 1).ravel())[::2]
        after[same] += 1
        order, common = order[at], after
    member, offset, common = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    return member, offset, common, _left(text, first, member, offset)


def intervals(common, least: int):
    """(common prefix, from, to): the common-prefix intervals of at least that depth, by a stack scan."""
    stack: list[list[int]] = []
    for i, c in enumerate(common):
        lo = i
        while stack and stack[-1][0] > c:
            depth, lo = stack.pop()
            yield depth, lo, i + 1
        if c >= least and (not stack or stack[-1][0] < c):
            stack.append([c, lo])


def _left_diverse(common: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, from, to) of the common-prefix intervals of at least SPAN whose suffixes differ in the byte to the left: the maximal repeats."""
    deep = common >= SPAN
    beside = np.r_[False, deep[:-1]] | np.r_[deep[1:], False]
    # two suffixes alone are one interval
    two = np.flatnonzero(deep & ~beside)
    two = two[(left[two] < 0) | (left[two + 1] < 0) | (left[two] != left[two + 1])]
    changes = np.r_[0, np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0))]
    found = []
    more = np.flatnonzero(deep & beside)
    begin = more[np.r_[True, np.diff(more) > 1]] if len(more) else more  # stretches between shallow places are scanned on their own
    end = more[np.r_[np.diff(more) > 1, True]] + 1 if len(more) else more
    diverse = (left[begin] < 0) | (changes[end] > changes[begin])  # in the others no interval is
    for a, b in zip(begin[diverse].tolist(), end[diverse].tolist(), strict=True):
        starts, change = (left[a : b + 1] < 0).tolist(), changes[a : b + 1].tolist()
        for depth, lo, hi in intervals([*common[a:b].tolist(), 0], SPAN):
            if starts[lo] or change[hi - 1] > change[lo]:
                found.append((depth, a + lo, a + hi))
    more = np.array(found, np.int64).reshape(-1, 3)
    return tuple(np.concatenate(c) for c in ((common[two], more[:, 0]), (two, more[:, 1]), (two + 2, more[:, 2])))


def maximal_repeats(members: list[bytes]) -> list[tuple[int, list[tuple[int, int]]]]:
    """(length, [(member, offset), ...]) of the maximal repeats of at least SPAN bytes, with all occurrences."""
    size = np.array([len(m) for m in members])
    member, offset, common, left = suffix_array(np.frombuffer(b"".join(members), np.uint8), size, np.zeros(len(members), np.int64))
    return [(int(n), list(zip(member[a:b].tolist(), offset[a:b].tolist(), strict=True))) for n, a, b in zip(*_left_diverse(common, left), strict=True)]


def covered(data: np.ndarray, size: np.ndarray, bucket: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, from, to): the stretches of windows of members that lie in an occurrence of a maximal repeat of their bucket."""
    member, offset, common, left = anchored_suffix_array(data, size, bucket, place)
    length, lo, hi = _left_diverse(common, left)
    times = hi - lo
    at = np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())  # all occurrences of all repeats
    # a place for each window of each member, and one more, which no repeat covers
    base = np.cumsum(size - SPAN + 2) - (size - SPAN + 2)
    begin = base[member[at]] + offset[at]
    n = int((size - SPAN + 2).sum())
    change = np.bincount(begin, minlength=n + 1) - np.bincount(begin + np.repeat(length, times) - SPAN + 1, minlength=n + 1)
    edge = np.flatnonzero(np.diff(np.r_[False, np.cumsum(change) > 0, False]))
    which = np.searchsorted(base, edge[::2], "right") - 1
    return which, edge[::2] - base[which], edge[1::2] - base[which]


def _whole_keys(batches):
    """Batches sorted by their first column, cut anew so that none parts the rows of a key: a key's rows are at most LIMIT."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = batch.column(0).to_numpy()
        last = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if last:
            yield batch.slice(0, last)
        held = batch.slice(last)
    if held is not None and held.num_rows:
        yield held


_FOUND = "gram long, seg long, off int, lo int, hi int"


def _search(buckets: DataFrame) -> DataFrame:
    """gram, seg, off and the covered windows lo .. hi - 1 after off, of rows (key, gram, seg, off, bytes, place of the gram in these): one suffix array per key."""

    def run(batches):
        for batch in _whole_keys(batches):
            key = batch.column(0).to_numpy()
            data, offsets = text_buffer(batch.column(4))
            size, place = np.diff(offsets), batch.column(5).to_numpy().astype(np.int64)
            first = np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)]
            windows = np.r_[0, np.cumsum(size - SPAN + 1)][first]
            a = 0
            while a < len(first) - 1:  # as many buckets at once as have about WINDOWS windows
                b = max(a + 1, int(np.searchsorted(windows, windows[a] + WINDOWS, "right")) - 1)
                x, y = first[a], first[b]
                which, lo, hi = covered(data[offsets[x] : offsets[y]], size[x:y], key[x:y], place[x:y])
                rows = pa.array(which + x)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in (1, 2, 3)), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["gram", "seg", "off", "lo", "hi"])
                a = b

    return buckets.select("key", "gram", "seg", "off", "bytes", "place").repartition("key").sortWithinPartitions("key").mapInArrow(releasing(run), _FOUND)


def _blocks(texts: DataFrame) -> DataFrame:
    """key (bytes that all windows of a block share), whole (all its bytes), gram, seg, off, bytes, place (of the gram in these): segments cut into blocks of windows.

    Windows are counted by their distance before the gram, so that blocks of different segments line up.
    """

    def run(batches):
        for batch in batches:
            keys, whole, rows = [], [], []
            for gram, seg, at, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                before, last = at >> 8 & 255, at & 255  # windows start from before down to last bytes before the gram
                b = np.arange(last // BLOCK, before // BLOCK + 1)
                far, near = np.minimum(before, b * BLOCK + BLOCK - 1), np.maximum(last, b * BLOCK)
                off, end = before - far, before - near + SPAN
                hasher = Hasher(np.frombuffer(text, np.uint8))
                inner = hasher.of(before - b * BLOCK, before - b * BLOCK - BLOCK + 1 + SPAN)
                keys.append(mix(inner ^ mix(b.astype(np.uint64) + np.uint64(gram % (1 << 64)))))
                whole.append(digests(text, off.tolist(), end.tolist(), far.tolist()))
                rows += [(gram, seg, int(x), text[x:y], int(z)) for x, y, z in zip(off, end, far, strict=True)]
            as_long = lambda x: pa.array((np.concatenate(x) if x else np.zeros(0, np.uint64)).view(np.int64))
            columns = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([as_long(keys), as_long(whole), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32()), strict=True))], names=["key", "whole", "gram", "seg", "off", "bytes", "place"])

    return texts.select("gram", "seg", "at", "bytes").mapInArrow(run, "key long, whole long, gram long, seg long, off int, bytes binary, place int")


def _windows(blocks_: DataFrame) -> DataFrame:
    """w (hash of a window), gram, seg, off, lo: every window of blocks."""

    def run(batches):
        for batch in batches:
            out = []
            for gram, seg, off, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = range(len(text) - SPAN + 1)
                found = digests(text, list(at), [i + SPAN for i in at], [0] * len(at)).view(np.int64).tolist()
                out += [(w, gram, seg, off, i) for w, i in zip(found, at, strict=True)]
            columns = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["w", "gram", "seg", "off", "lo"])

    return blocks_.select("gram", "seg", "off", "bytes").mapInArrow(run, "w long, gram long, seg long, off int, lo int")


def _search_hot(texts: DataFrame) -> DataFrame:
    """What _search finds, for grams of too many classes to gather."""
    cut = materialize(_blocks(texts))
    # of each class its size and its first member, by which its bytes are found again: no class is joined with itself
    classes = cut.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("gram", "seg", "off")).alias("r"))
    classes = materialize(classes)
    sizes = materialize(classes.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).filter("total > 1"))
    classes = materialize(classes.join(sizes, "key"))
    whole = cut.join(classes.filter("n > 1").select("key", "whole"), ["key", "whole"])
    whole = whole.select("gram", "seg", "off", F.lit(0).alias("lo"), (F.octet_length("bytes") - SPAN + 1).alias("hi"))
    # one member of each class goes on
    first = classes.filter("m > 1").select("key", "m", "r.*")
    one = materialize(cut.select("gram", "seg", "off", "bytes", "place").join(first, ["gram", "seg", "off"]).select("key", "m", "gram", "seg", "off", "bytes", "place"))
    single = _windows(one.filter(F.col("m") > LIMIT))
    twice = materialize(single.groupBy("gram", "w").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("gram", "w"))
    single = single.join(twice, ["gram", "w"]).select("gram", "seg", "off", "lo", (F.col("lo") + 1).alias("hi"))
    return whole.union(_search(one.filter(F.col("m") <= LIMIT))).union(single)


def _texts(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """gram, seg, at, hot, bytes of the segments reps (kid, th, gram, seg, at, hot)."""
    wanted = reps.groupBy("kid", "th").agg(F.collect_list(F.struct("gram", "seg", "at", "hot")).alias("s"))  # at most as many as a text has bytes

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            row = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
            gram, seg, at, hot = batch.column(1).flatten().flatten()
            place = at.to_numpy()
            start = (place >> 16) - (place >> 8 & 255) + offsets[row]
            size = (place >> 8 & 255) - (place & 255) + SPAN
            for a in range(0, len(row), TEXTS):
                one = slice(a, a + TEXTS)
                end = np.cumsum(size[one])
                take = np.repeat(start[one] - end + size[one], size[one])
                text = data[take + np.arange(len(take))]
                found = pa.Array.from_buffers(pa.binary(), len(end), [None, pa.py_buffer(np.r_[0, end].astype(np.int32)), pa.py_buffer(text)])
                yield pa.RecordBatch.from_arrays([*(c.slice(a, len(end)) for c in (gram, seg, at, hot)), found], names=["gram", "seg", "at", "hot", "bytes"])

    return _flagged(docs, reps).join(wanted, ["kid", "th"]).select("text", "s").mapInArrow(run, "gram long, seg long, at long, hot boolean, bytes binary")


def spans(docs: DataFrame) -> DataFrame:
    """kid, th, span (start << 16 | length): byte stretches made of windows that repeat, of docs (kid, th, text); they may overlap."""
    owned = materialize(_owned(docs))
    # the small side of each join on a gram is written first: a join of plain exchanges, whose hot grams Spark can split
    repeated = materialize(owned.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.min("seg").alias("a"), F.max("seg").alias("z")).filter("c > 1"))
    shared = materialize(owned.join(repeated, "gram").select("gram", "seg", "kid", "th", "at", (F.col("a") != F.col("z")).alias("multi")))
    classes = shared.groupBy("gram", "seg").agg(F.count(F.lit(1)).alias("n"), F.max("multi").alias("multi"), F.min(F.struct("kid", "th", "at")).alias("r"))
    classes = materialize(classes.select("gram", "seg", "n", "multi", "r.*"))
    before = F.shiftright("at", 8).bitwiseAND(255)
    span = lambda off, length: F.shiftleft(F.shiftright("at", 16) - before + off, 16).bitwiseOR(length.cast("long")).alias("span")
    full = shared.join(classes.filter("n > 1").select("gram", "seg"), ["gram", "seg"])
    full = full.select("kid", "th", span(F.lit(0), before - F.col("at").bitwiseAND(255) + SPAN))
    several = classes.filter("multi")
    counts = materialize(several.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("fewest")).filter("fewest = 1"))  # else all its classes repeat whole
    reps = several.join(counts, "gram").select("kid", "th", "gram", "seg", "at", (F.col("m") > LIMIT).alias("hot"))
    texts = materialize(_texts(docs, reps))
    found = _search(texts.filter("NOT hot").select(F.col("gram").alias("key"), "gram", "seg", F.lit(0).alias("off"), "bytes", before.cast("int").alias("place"))).union(_search_hot(texts.filter("hot")))
    part = found.join(classes.filter("n = 1").select("gram", "seg", "kid", "th", "at"), ["gram", "seg"])
    part = part.select("kid", "th", span(F.col("off") + F.col("lo"), F.col("hi") - F.col("lo") - 1 + SPAN))
    return full.union(part)


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    keyed = docs.select(F.col(quoted(id_col)).alias("id"), F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit(-(1 << 63))).alias("kid"), F.xxhash64(text).alias("th"), text.alias("text"))
    narrow = keyed.select("kid", "th", "text")
    bound_batches(docs.sparkSession)
    with scope(docs.sparkSession):
        with scope(docs.sparkSession):
            found = materialize(spans(narrow), keep=True)
        return materialize(_cut(keyed, narrow, found, id_col), keep=True)


def _cut(keyed: DataFrame, narrow: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """The rows of keyed (id, kid, th, text) after the stretches found (kid, th, span) are cut."""
    merged = found.groupBy("kid", "th").agg(F.collect_set("span").alias("spans"))  # of one text

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = text_buffer(batch.column(2))
            row = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            span = batch.column(3).flatten().to_numpy()
            order = np.lexsort((span, row))
            row, span = row[order], span[order]
            start = (span >> 16) + offsets[row]
            end = np.maximum.accumulate(start + (span & 0xFFFF))  # no stretch reaches into the next text
            new = np.r_[True, (row[1:] != row[:-1]) | (start[1:] > end[:-1])]
            row, start, end = row[new], start[new], end[np.r_[new[1:], True]]
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            gone = np.r_[0, np.cumsum(end - start)]
            view, digest = memoryview(data), []
            start, end, texts = start.tolist(), end.tolist(), offsets.tolist()
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                at, kept = texts[i], hashlib.sha256()
                for k in range(a, b):
                    kept.update(view[at : start[k]])
                    at = end[k]
                kept.update(view[at : texts[i + 1]])
                digest.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone[first[1:]] - gone[first[:-1]]), pa.array(np.diff(first)), pa.array(digest, pa.string())], names=["kid", "th", "n_removed", "n_spans", "kept_sha256"])

    cut = _flagged(narrow, found).join(merged, ["kid", "th"]).mapInArrow(run, "kid long, th long, n_removed long, n_spans long, kept_sha256 string")
    # written, so that the join has plain exchanges on both sides and Spark can split rows that are repeated very often
    cut = materialize(cut)
    base = keyed.select("id", "kid", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    joined = base.join(cut, ["kid", "th"], "left")
    return joined.select(F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, k, md5(substr(h, 2 * k + 1, 400)) AS g FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS k FROM d WHERE n >= 200)),
twice AS (SELECT g FROM w GROUP BY g HAVING count(*) > 1),
c AS (SELECT doc_id, k, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) <= 200 THEN 0 ELSE 1 END AS fresh FROM w JOIN twice USING (g)),
s AS (SELECT doc_id, min(k) AS a, max(k) + 200 AS b FROM (SELECT doc_id, k, sum(fresh) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM c) GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(b) AS last, sum(b - a) AS n_removed, count(*) AS n_spans FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
