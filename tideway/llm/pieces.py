"""Sampled SentencePiece segmentation and lossless decoding (operator 2).

A text is cut at spaces into units that no piece crosses. For each distinct unit the lattice
of pieces is filtered forward once: every place gets the summed weight of the segmentations
that reach it, and each piece that ends there its share. Segmentations are then sampled
backward for all occurrences of a block at once, each draw a hash of (seed, row key, unit,
step), so that a row's pieces depend on its key and text alone, not on partitions or
retries. Weights are piece probabilities to the power alpha; a BPE model has merge ranks
instead of probabilities, and gets Zipf's, 1 / rank. Characters without a piece become byte
pieces, and so does a literal U+2581 (which pieces use for the space): decoding gives back
the text, byte for byte.

Defined results: a null or empty text has no pieces and decodes to the empty text; equal
keys with equal texts get equal pieces; very long texts are sampled like others, in blocks,
and a very long unit is filtered with rescaled weights; the tables of distinct units are
dropped once they pass CACHE_EDGES; the model is read on the driver and broadcast.
"""

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import bound_batches
from .textbytes import blocks, mix, releasing, text_buffer

#: The model's path, unless encode() or the environment variable SENTENCEPIECE_MODEL names another.
MODEL = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
ALPHA = 0.5
CACHE_EDGES = 1_500_000
_UNIT = re.compile(r" *[^ ]+| +")


def read_model(path: str = MODEL) -> dict:
    """The parts of a SentencePiece model that segmentation needs."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    kinds = pb.ModelProto.SentencePiece
    pieces, log_p, surface, bytes_ = {}, [], [], {}
    ranked = 0
    for i, p in enumerate(proto.pieces):
        surface.append(b"")
        log_p.append(0.0)
        if p.type == kinds.BYTE:
            bytes_[int(p.piece[3:5], 16)] = i
            surface[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
            ranked += 1
            text = p.piece.replace("▁", " ")
            surface[i] = text.encode()
            log_p[i] = float(p.score) if proto.trainer_spec.model_type == pb.TrainerSpec.UNIGRAM else -float(np.log(ranked))
            if " " in text.lstrip(" "):
                raise ValueError(f"piece {p.piece!r} crosses a space")
            pieces[text] = i
    if len(bytes_) < 256:
        raise ValueError("the model has no byte pieces, so that decoding would lose characters")
    least = min(log_p)
    return {"pieces": pieces, "log_p": log_p, "surface": surface, "bytes": [bytes_[b] for b in range(256)], "least": least, "prefix": proto.normalizer_spec.add_dummy_prefix}


_K = np.uint64(0x100000001B3)
#: Bytes of text that are segmented together.
TEXT_BYTES = 1 << 18
#: Units up to this length are filtered together; longer ones one by one.
TOGETHER = 64
#: Shares are kept to this part, so that draws compare exactly wherever a unit's table lies.
PART = 2.0**-20


def _longer(x: np.ndarray) -> np.ndarray:
    """x with as much room again, which takes memory only once it is written."""
    out = np.empty(2 * len(x), x.dtype)
    out[: len(x)] = x
    return out


class Lattice:
    """Forward-filtered tables of the units seen, and backward sampling over them."""

    def __init__(self, model: dict, alpha: float):
        self.model = model
        self.pieces = {t: (i, float(np.exp(alpha * model["log_p"][i]))) for t, i in model["pieces"].items()}
        self.begins = {t[:k] for t in model["pieces"] for k in range(1, len(t) + 1)}
        self.longest = max(map(len, self.pieces), default=1)
        self.byte_weight = float(np.exp(alpha * model["least"]))
        self.vocabulary = len(model["surface"])
        begins = sorted(self.begins)
        hashes = np.zeros(len(begins), np.uint64)
        for k in range(self.longest):
            on = np.array([len(t) > k for t in begins])
            hashes[on] = hashes[on] * _K + np.array([ord(t[k]) + 1 for t in begins if len(t) > k], np.uint64)
        order = np.argsort(mix(hashes))
        self.begin_hash = mix(hashes)[order]
        found = [self.pieces.get(begins[i], (-1, 0.0)) for i in order]
        self.begin_id, self.begin_weight = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found])
        self.clear()

    def clear(self) -> None:
        self.ends: dict[str, int] = {}  # unit -> its last node
        self.nodes = self.edges = 0
        # by edge, in order of the node it ends in: that node + cumulated share, node it starts in (-1: start of the unit), code
        self.cum, self.pred, self.code = np.zeros(1 << 16), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.chains: dict[str, int] = {}  # character of several byte pieces -> code - vocabulary

    def _bytes(self, char: str) -> int:
        raw = char.encode()
        if len(raw) == 1:
            return self.model["bytes"][raw[0]]
        return self.vocabulary + self.chains.setdefault(char, len(self.chains))

    def _keep(self, node: np.ndarray, share: np.ndarray, pred: np.ndarray, code: np.ndarray) -> None:
        """Append edges sorted by node, each with its share of its node."""
        n = len(node)
        while self.edges + n > len(self.cum):
            self.cum, self.pred, self.code = (_longer(x) for x in (self.cum, self.pred, self.code))
        first = np.r_[True, node[1:] != node[:-1]]
        start = np.flatnonzero(first)
        rank = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
        acc = share.copy()
        for k in range(1, int(rank.max()) + 1):
            at = np.flatnonzero(rank == k)
            acc[at] += acc[at - 1]
        acc = np.minimum(np.floor(acc / PART) * PART, 1.0)
        acc[np.r_[first[1:], True]] = 1.0
        to = slice(self.edges, self.edges + n)
        self.cum[to], self.pred[to], self.code[to] = node + acc, pred, code
        self.edges += n

    def add(self, units: list[str]) -> None:
        """Filter new units forward."""
        short = [u for u in units if len(u) <= TOGETHER]
        if short:
            self._add_short(short)
        for u in units:
            if len(u) > TOGETHER:
                self._add_long(u)

    def _add_short(self, units: list[str]) -> None:
        chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        size = np.array([len(u) for u in units])
        first = np.cumsum(size) - size
        unit = np.repeat(np.arange(len(units)), size)
        last, place = (first + size)[unit], np.arange(len(chars)) - first[unit]
        node_at = np.arange(len(chars)) + unit  # node where each character starts; a unit has one more than characters
        active, h, found = np.arange(len(chars)), np.zeros(len(chars), np.uint64), []
        for k in range(1, self.longest + 1):
            fits = active + k <= last[active]
            active, h = active[fits], h[fits]
            h = h * _K + (chars[active + k - 1].astype(np.uint64) + np.uint64(1))
            m = mix(h)
            at = np.minimum(np.searchsorted(self.begin_hash, m), len(self.begin_hash) - 1)
            known = self.begin_hash[at] == m
            if k == 1:
                none = active[~known | (self.begin_id[at] < 0)]
                kinds, which = np.unique(chars[none], return_inverse=True)
                codes = np.array([self._bytes(chr(c)) for c in kinds], np.int64)
                found.append((none, np.ones(len(none), np.int64), codes[which] if len(none) else np.zeros(0, np.int64), np.full(len(none), self.byte_weight)))
            active, h, at = active[known], h[known], at[known]
            hit = self.begin_id[at] >= 0
            found.append((active[hit], np.full(int(hit.sum()), k), self.begin_id[at[hit]], self.begin_weight[at[hit]]))
            if not len(active):
                break
        start, k, code, weight = (np.concatenate(x) for x in zip(*found, strict=True))
        node, where = node_at[start] + k, place[start] + k
        order = np.argsort(where * (len(chars) + len(units) + 1) + node, kind="stable")
        start, code, weight, node, where = start[order], code[order], weight[order], node[order], where[order]
        total = np.zeros(len(chars) + len(units))
        total[first + np.arange(len(units))] = 1.0
        cuts = np.searchsorted(where, np.arange(1, int(where[-1]) + 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # all edges that end after so many characters of their units
            weight[a:b] *= total[node_at[start[a:b]]]
            group = np.flatnonzero(np.r_[True, node[a + 1 : b] != node[a : b - 1]])
            total[node[a + group]] = np.add.reduceat(weight[a:b], group)
        order = np.argsort(node, kind="stable")
        start, code, weight, node = start[order], code[order], weight[order], node[order]
        self._keep(self.nodes + node, weight / total[node], np.where(place[start] > 0, self.nodes + node_at[start], -1), code)
        for u, e in zip(units, (self.nodes + first + np.arange(len(units)) + size).tolist(), strict=True):
            self.ends[u] = e
        self.nodes += len(total)

    def _add_long(self, unit: str) -> None:
        n, base, pieces, begins = len(unit), self.nodes, self.pieces, self.begins
        into: dict[int, list] = {k: [] for k in range(self.longest + 1)}  # edges into the places ahead, by place modulo
        node, share, pred, code_of = [], [], [], []
        for j in range(n + 1):
            here = 1.0
            if j:
                edges = into[j % (self.longest + 1)]
                here = sum(e[2] for e in edges)
                for i, code, w in edges:
                    node.append(base + j)
                    share.append(w / here)
                    pred.append(base + i if i else -1)
                    code_of.append(code)
                into[j % (self.longest + 1)] = []
                if here < 1e-100:  # only ratios count: scale what later places can still see
                    for edges in into.values():
                        for e in edges:
                            e[2] *= 1e100
                    here *= 1e100
            if j == n:
                break
            k = j + 1
            if unit[j] not in pieces:
                into[k % (self.longest + 1)].append([j, self._bytes(unit[j]), here * self.byte_weight])
            while k <= n:
                s = unit[j:k]
                if s not in begins:
                    break
                if hit := pieces.get(s):
                    into[k % (self.longest + 1)].append([j, hit[0], here * hit[1]])
                k += 1
        self._keep(np.array(node), np.array(share), np.array(pred), np.array(code_of))
        self.nodes = base + n + 1
        self.ends[unit] = base + n

    def sample(self, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all occurrences in order, and how many each has; ends: last nodes; keys: one hash per occurrence."""
        cum, pred, code = self.cum[: self.edges], self.pred, self.code
        active, node, picked, whose, step = np.arange(len(ends)), ends, [], [], 0
        while len(active):
            r = (mix(keys[active] + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(44)) * PART
            e = np.searchsorted(cum, node + r, "right")
            picked.append(code[e])
            whose.append(active)
            node = pred[e]
            on = node >= 0
            active, node, step = active[on], node[on], step + 1
        if not picked:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        counts = np.bincount(np.concatenate(whose), minlength=len(ends))
        after = np.cumsum(counts)
        out = np.empty(after[-1], np.int64)
        for k, (c, w) in enumerate(zip(picked, whose, strict=True)):
            out[after[w] - 1 - k] = c
        return out, counts

    def expand(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, with characters of several bytes written out, and the number of ids of each code."""
        many = np.flatnonzero(codes >= self.vocabulary)
        size = np.ones(len(codes), np.int64)
        if not len(many):
            return codes, size
        of = [[self.model["bytes"][b] for b in c.encode()] for c in self.chains]
        size[many] = np.array([len(x) for x in of])[codes[many] - self.vocabulary]
        ids = np.repeat(codes, size)
        at = np.cumsum(size) - size
        for i in many:
            ids[at[i] : at[i] + size[i]] = of[codes[i] - self.vocabulary]
        return ids, size

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and offsets of the texts."""
        if self.edges > CACHE_EDGES:
            self.clear()
        prefix = " " if self.model["prefix"] else ""
        units, count = [], []
        for t in texts:
            own = _UNIT.findall(prefix + t) if t else []
            units += own
            count.append(len(own))
        self.add([u for u in dict.fromkeys(units) if u not in self.ends])
        ends = [self.ends[u] for u in units]
        count = np.array(count, np.int64)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        occurrence = mix(np.repeat(keys, count) + at.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        codes, per_unit = self.sample(np.array(ends, np.int64), occurrence)
        ids, size = self.expand(codes)
        last = lambda sizes, cuts: np.concatenate([[0], np.cumsum(sizes)])[cuts]
        by_text = last(per_unit, np.concatenate([[0], np.cumsum(count)]))
        return ids, last(size, by_text)

    def decode(self, ids: np.ndarray) -> bytes:
        out = b"".join(map(self.model["surface"].__getitem__, ids.tolist()))
        return out[1:] if self.model["prefix"] and len(ids) else out


_lattices: dict = {}


def encode(docs: DataFrame, key_col: str, text_col: str = "text", model: str = MODEL, alpha: float = ALPHA, seed: int = 0) -> DataFrame:
    """key, piece_ids, n_pieces, decoded_sha256 (of the decoded ids) and lossless (decoding gave the text)."""
    spark: SparkSession = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(read_model(model))
    name = f"{model}:{alpha}"
    kind = docs.schema[key_col].dataType.simpleString()

    def run(batches):
        if name not in _lattices:  # kept between the tasks of a worker
            _lattices.clear()
            _lattices[name] = Lattice(shared.value, alpha)
        lattice = _lattices[name]
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b in blocks(offsets, TEXT_BYTES):
                raw = [data[s:e].tobytes() for s, e in zip(offsets[a:b], offsets[a + 1 : b + 1], strict=True)]
                ids, cuts = lattice.encode([t.decode() for t in raw], keys[a:b])
                decoded = [lattice.decode(ids[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
                arrays = [
                    batch.column(0).slice(a, b - a),
                    pa.array(np.diff(cuts)),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array([hashlib.sha256(t).hexdigest() for t in decoded], pa.string()),
                    pa.array([x == y for x, y in zip(raw, decoded, strict=True)]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "n_pieces", "piece_ids", "decoded_sha256", "lossless"])

    narrow = docs.select(F.col(key_col).alias("key"), F.xxhash64(F.col(key_col).cast("string"), F.lit(seed)).alias("draw"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(releasing(run), f"key {kind}, n_pieces long, piece_ids array<int>, decoded_sha256 string, lossless boolean")


def query(docs: DataFrame) -> DataFrame:
    return encode(docs, "doc_id").withColumnRenamed("key", "doc_id")
