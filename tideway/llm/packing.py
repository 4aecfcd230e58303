"""Best-fit packing with a swap-based local search (operator 13): token pieces into sequences of a fixed capacity.

1. Texts become token ids, each with an end id; documents longer than the capacity are cut, and
   every full piece is a sequence of its own. Ids are found per distinct word of a block:
   the tokenizer's normalization and splits never reach over ASCII white space, so a text's
   ids are those of its words in a row; a worker keeps the words it has seen, and numpy lays the ids out.
2. The other pieces are dealt by a hash of their row number into blocks of about BLOCK, however
   alike their lengths, documents or sources are. Each block is packed best-fit, longest first,
   and then searched: of the exchanges between an underfull source bin, the emptiest first, and
   other underfull bins (move a piece; one for one; two for one; one for two) the one that adds
   most to the sum of squared fills is made, until the source is empty or none adds anything.
   The sum grows with every exchange, so the search ends.
3. What still leaves room is dealt anew among fewer blocks, and so on down to one: of each block
   the emptiest bin, and bins with more than a sixteenth free, up to an eighth of its bins, so that
   every round takes a small part of the one before.

A sequence's id is the least row number of its pieces, so blocks need not agree on numbers.

Defined results: a null or empty text is the end id alone, one piece; rows with null or repeated
ids are documents of their own; ties between pieces of equal length are settled by row number;
a very long text gives many full pieces; an empty table gives an empty result; other columns
play no part. Row numbers follow the partitions of docs, and with them which bins pieces share.
"""

import os
import re
import zlib
from struct import pack as packed

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .store import bound_batches, materialize, quoted, scope
from .textbytes import LOWER, NON_SPACE, blocks, byte_class, releasing, text_buffer, word_hashes

CAPACITY = 2048
BLOCK = 16_384
END_ID = 0
TEXT_BYTES = 2 << 20
#: Words that a worker keeps; then it starts anew. Longer ones than WORD_BYTES are not kept.
WORDS = 1 << 20
WORD_BYTES = 64
#: Small letters of ASCII and letters of Latin-1, as UTF-8: normalization changes none but their case, and they are one stretch for the tokenizer.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
#: The tokenizer always cuts between a letter and these: its special tokens have no such place, and no mark after it joins the letter.
PUNCTUATION = byte_class(lambda b: b in b".,;:!?")
LETTER = byte_class(lambda b: b < 0x80 and chr(b).isalpha())
#: First bytes of characters beyond Latin-1: marks that join the letter before may be among them.
BEYOND = byte_class(lambda b: b >= 0xC4)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte, last byte + 1) of the words of texts: parts whose ids in a row are the text's.

    The bytes are in lower case, as the tokenizer takes them, where that changes nothing else: not in texts that
    may hold a special token or a mark that joins a letter.
    """
    n = len(data)
    odd = BEYOND[data]
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    keep = np.diff(np.r_[0, np.cumsum(odd)][offsets]) > 0
    low = LOWER[data]
    for s, e in zip(offsets[:-1][keep], offsets[1:][keep], strict=True):
        low[s:e] = data[s:e]
    inside = NON_SPACE[low]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | (LETTER[low[:-1]] & PUNCTUATION[low[1:]])
    firsts = offsets[:-1][offsets[:-1] < n]
    fresh[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | fresh[1:]
    return low, np.flatnonzero(fresh), np.flatnonzero(ends) + 1


class WordIds:
    """Words as bytes, each with its token ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.known: dict[bytes, bytes] = {}
        self.tokenizer = t = Tokenizer.from_file(path)
        stretch = lambda c: "".join(x for x, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(c)))
        self.letters = {c: stretch(chr(c)) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)}  # what the model gets for them

    def _learn(self, words: set[bytes]) -> None:
        """Plain words go to the tokenizer's model at once; others through its normalization and splits first."""
        tokenize, known, rest = self.tokenizer.model.tokenize, self.known, []
        for w in words:
            if PLAIN(w):
                known[w] = packed(f"<{len(found := tokenize(w.decode() if w.isascii() else w.decode().translate(self.letters)))}I", *(t.id for t in found))
            else:
                rest.append(w)
        for a in range(0, len(rest), 4096):
            some = rest[a : a + 4096]
            for word, e in zip(some, self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
                known[word] = np.array(e.ids, "<u4").tobytes()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, first place of each text's and the end) of some texts."""
        if len(self.known) > WORDS:
            self.known.clear()
        low, starts, ends = words(data, offsets)
        _, first, which = np.unique(word_hashes(low, starts, ends), return_index=True, return_inverse=True)
        raw = low.tobytes()
        # equal hashes are taken for equal words where length and first bytes agree too
        same = self._same(low, starts, ends, first[which])
        each = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        if not same:
            each = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            which = np.arange(len(each))
        new = set(each).difference(self.known)
        self._learn(new)
        found = [self.known[w] for w in each]
        for w in new:
            if len(w) > WORD_BYTES:
                del self.known[w]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        base = np.cumsum(size) - size
        times = size[which]
        place = np.cumsum(times) - times
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(base[which] - place, times) + np.arange(times.sum())]
        return ids, np.r_[0, np.cumsum(times)][np.searchsorted(starts, offsets)]

    @staticmethod
    def _same(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
        padded = np.zeros(len(low) + 8, np.uint8)
        padded[: len(low)] = low
        eight = np.ndarray((len(low) + 1,), "<u8", padded, 0, (1,))
        size = ends - starts
        mask = (np.uint64(1) << (np.minimum(size, 7).astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        begin = eight[starts] & mask
        return bool((size == size[other]).all() and (begin == begin[other]).all())


_kept: dict[str, WordIds] = {}


def pieces(docs: DataFrame, id_col: str, text_col: str, model: str, capacity: int, ids: bool = False) -> DataFrame:
    """item (a row number), id, piece, start, length, ids_crc32 of every piece, and its ids where asked for."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    bound_batches(docs.sparkSession)

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if model not in _kept:  # kept between the tasks of a worker
            _kept.clear()
            _kept[model] = WordIds(model)
        item = TaskContext.get().partitionId() << 36
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in blocks(offsets, TEXT_BYTES):
                rows, own = [], []
                found, cuts = _kept[model].encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for row, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), a):
                    whole = np.append(found[x:y], np.uint32(END_ID)).astype("<u4")
                    for at in range(0, len(whole), capacity):
                        part = whole[at : at + capacity]
                        rows.append((item, row, at // capacity, at, len(part), zlib.crc32(part)))
                        if ids:
                            own.append(part.astype(np.int64))
                        item += 1
                number, row, *rest = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
                columns = [number, batch.column(0).take(row), rest[0].cast(pa.int32()), *rest[1:]]
                names = ["item", "id", "piece", "start", "length", "ids_crc32"]
                if ids:
                    sizes = np.cumsum([0, *map(len, own)])
                    columns.append(pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(own))))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "ids"][: len(columns)])

    narrow = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    schema = f"item long, id {narrow.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return narrow.mapInArrow(releasing(run), schema + (", ids array<long>" if ids else ""))


def best_fit(size: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece: longest first, into the fullest bin that takes it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, n = 0, 0  # a bit for each amount of room that some bin has
    out = np.zeros(len(size), np.int64)
    for i in np.argsort(-size, kind="stable").tolist():
        s = int(size[i])
        fitting = open_rooms >> s
        if fitting:
            room = s + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, bin_, n = capacity, n, n + 1
        out[i] = bin_
        if room > s:
            by_room[room - s].append(bin_)
            open_rooms |= 1 << (room - s)
    return out


class Search:
    """Exchanges between underfull bins that add to the sum of squared fills."""

    def __init__(self, size: np.ndarray, bin_of: np.ndarray, capacity: int):
        self.size, self.bin, self.capacity = size, bin_of.copy(), capacity
        self.fill = np.bincount(bin_of, size, minlength=1).astype(np.int64)
        self.least = max(-(-int(size.sum()) // capacity), int((2 * size > capacity).sum()))  # no packing has fewer bins

    def _stock(self):
        """(item, another of equal length and bin or -1, length, bin) per length in each underfull bin, by bin."""
        item = np.flatnonzero(self.fill[self.bin] < self.capacity)
        item = item[np.lexsort((self.size[item], self.bin[item]))]
        key = self.bin[item] * (self.capacity + 1) + self.size[item]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.r_[first, len(key)])
        other = np.where(times > 1, item[np.minimum(first + 1, max(len(item) - 1, 0))], -1)
        return item[first], other, self.size[item[first]], self.bin[item[first]]

    @staticmethod
    def _pairs(item, other, size, bin_):
        """(item, item, lengths' sum, bin) of the pairs of lengths in each bin."""
        out = []
        twin = np.flatnonzero(other >= 0)
        out.append((item[twin], other[twin], 2 * size[twin], bin_[twin]))
        for d in range(1, len(item)):
            i = np.flatnonzero(bin_[d:] == bin_[:-d])
            if not len(i):
                break
            out.append((item[i], item[i + d], size[i] + size[i + d], bin_[i]))
        return [np.concatenate(c) for c in zip(*out, strict=True)]

    def _best(self, give: np.ndarray, take: np.ndarray, to: np.ndarray, source: int):
        """(gain, number in give, number in take) of the best exchange of a length for another of a bin to; gain 0: none."""
        delta = give[:, None] - take[None, :]
        room = self.capacity - self.fill[to]
        gain = np.where((delta > 0) & (delta <= room), delta * (self.fill[to] - self.fill[source] + delta), 0)
        k = int(gain.argmax()) if gain.size else 0
        return (int(gain.flat[k]) if gain.size else 0, *divmod(k, max(len(take), 1)))

    def _exchange(self, source: int, out, back, target: int) -> None:
        for i in out:
            self.bin[i] = target
        for i in back:
            self.bin[i] = source
        delta = int(self.size[list(out)].sum() - self.size[list(back)].sum())
        self.fill[target] += delta
        self.fill[source] -= delta

    def improve(self, source: int) -> bool:
        """Make the best exchange of source; whether there was one."""
        stock = self._stock()
        mine = stock[3] == source
        own, rest = [c[mine] for c in stock], [c[~mine] for c in stock]
        bins = np.unique(rest[3])
        nothing = np.zeros(len(bins), np.int64)
        # moves, and one for one
        take, to, back = np.r_[nothing, rest[2]], np.r_[bins, rest[3]], np.r_[nothing - 1, rest[0]]
        gain, g, t = self._best(own[2], take, to, source)
        if gain > 0:
            self._exchange(source, [own[0][g]], [back[t]] if back[t] >= 0 else [], int(to[t]))
            return True
        two = self._pairs(*own)
        gain, g, t = self._best(two[2], rest[2], rest[3], source)
        if gain > 0:
            self._exchange(source, [two[0][g], two[1][g]], [rest[0][t]], int(rest[3][t]))
            return True
        theirs = self._pairs(*rest)
        gain, g, t = self._best(own[2], theirs[2], theirs[3], source)
        if gain > 0:
            self._exchange(source, [own[0][g]], [theirs[0][t], theirs[1][t]], int(theirs[3][t]))
            return True
        return False

    def run(self) -> np.ndarray:
        """Search until no source has an exchange left, or the least number of bins is reached and the emptiest has none."""
        stuck: set[bytes] = set()
        while True:
            under = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
            done = True
            for source in under[np.argsort(self.fill[under], kind="stable")].tolist():
                sign = np.sort(self.size[self.bin == source]).tobytes()
                if sign in stuck:  # an equal bin found none, and nothing has changed
                    continue
                moved = False
                while self.fill[source] and self.improve(source):
                    moved = True
                if moved:
                    stuck.clear()
                    done = False
                    break
                stuck.add(sign)
                if int((self.fill > 0).sum()) <= self.least:
                    break
            if done:
                return self.bin


def pack_block(size: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each piece of a block."""
    return Search(size, best_fit(size, capacity), capacity).run() if len(size) else np.zeros(0, np.int64)


def _round(items: DataFrame, n: int, turn: int, capacity: int) -> DataFrame:
    """item, length, sequence_id, offset, open (its bin is one of the emptiest of its block) of items dealt into n blocks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        item, size = table["item"].to_numpy(), table["length"].to_numpy()
        bin_ = pack_block(size, capacity)
        order = np.lexsort((item, bin_))
        item, size, bin_ = item[order], size[order], bin_[order]
        first = np.flatnonzero(np.r_[True, bin_[1:] != bin_[:-1]])
        count = np.diff(np.r_[first, len(bin_)])
        place = np.cumsum(size) - size
        fill = np.add.reduceat(size, first)
        emptiest = np.argsort(fill, kind="stable")[: -(-len(fill) // 8)]
        open_ = np.zeros(len(fill), bool)
        open_[emptiest] = 16 * (capacity - fill[emptiest]) > capacity
        open_[emptiest[:1]] = fill[emptiest[:1]] < capacity
        return pa.table({"item": item, "length": size, "sequence_id": np.repeat(item[first], count), "offset": place - np.repeat(place[first], count), "open": np.repeat(open_, count)})

    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(n)).alias("block"))
    # a partition a block or so, however few bytes they have: the search takes time, not room
    return dealt.repartition(n, "block").groupBy("block").applyInArrow(run, "item long, length long, sequence_id long, offset long, open boolean")


def place(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """item, sequence_id, offset of items (item, length) shorter than capacity."""
    out, turn = [], 0
    while True:
        n = -(-items.count() // block)
        packed = materialize(_round(items, max(n, 1), turn, capacity))
        if n <= 1:
            out.append(packed)
            break
        out.append(packed.filter("NOT open"))
        items, turn = packed.filter("open"), turn + 1
    placed = out[0]
    for more in out[1:]:
        placed = placed.union(more)
    return placed.select("item", "sequence_id", "offset")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32, (ids,) sequence_id, offset of every piece of docs."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("word_bpe_49k.json")
    with scope(docs.sparkSession):
        made = materialize(pieces(docs, id_col, text_col, str(model), capacity, ids), keep=True)
        full = F.col("length") >= capacity
        placed = place(made.filter(~full).select("item", "length"), capacity)
        short = made.filter(~full).join(placed, "item")
        whole = made.filter(full).withColumns({"sequence_id": F.col("item"), "offset": F.lit(0).cast("long")})
        out = materialize(short.unionByName(whole).drop("item"), keep=True)
    return out.withColumnRenamed("id", id_col)


def query(docs: DataFrame) -> DataFrame:
    return pack(docs)
