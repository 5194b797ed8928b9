"""Sampled segmentations into SentencePiece pieces, and lossless decoding.

Every way to cut a text into pieces of the vocabulary is a path through a lattice; a path's weight is the product of its
pieces' weights, which fall with the piece's rank. Forward filtering sums the weights of all paths to each place, and
backward sampling draws a path from its end by exactly its share. Random numbers are a hash of seed, row key, segment
and draw, so a row's segmentation depends on its key and text alone.

No piece of the vocabulary goes on over a blank or a line break, so all paths meet before each run of blanks and around
each line break: the lattice falls into segments, and forward sums of equal segments are made once and kept in a
bounded cache. All segments of a batch of rows are drawn in step, as arrays. Characters without a piece are written as
byte pieces, so is the vocabulary's blank mark where a text holds it; decoding therefore gives back any text.

Defined cases: null text gives null ids, and null again when decoded; empty text gives no ids; a null key counts as key
0; repeated rows are segmented alike; other columns take no part.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import parts_of, table

SEED = 1
#: Weight of the piece of rank r: (r + RANK_SHIFT) ** -SHARPNESS; of a byte: BYTE_WEIGHT.
RANK_SHIFT = 10.0
SHARPNESS = 1.0
BYTE_WEIGHT = 1e-6
#: Distinct segments in a task's cache and their characters at most, and rows that are drawn together.
CACHE_SEGMENTS = 150_000
CACHE_PLACES = 1_500_000
BATCH_ROWS = 300
#: Characters from which a segment is gone through on its own.
LONG = 2000

MARK = "▁"
_SEGMENT = re.compile("[\n" + MARK + "]| *[^ \n" + MARK + "]+| +")
_U = np.uint64
#: Powers of an odd number modulo 2^64, for hashes of substrings.
_POWERS = np.cumprod(np.array([1] + [0xD6E8FEB86659FD93] * 255, np.uint64), dtype=np.uint64)
#: Places whose forward sums are made at once.
PLACES = 400_000


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary: ids and log weights of pieces with blanks for marks, ids of bytes, and texts by id."""

    def __init__(self, path: str, rank_shift: float = RANK_SHIFT, sharpness: float = SHARPNESS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, tuple[int, float]] = {}
        self.byte = [0] * 256
        self.text: list[str | int] = [""] * sp.get_piece_size()
        rank = 0
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                self.text[i] = int(sp.id_to_piece(i)[1:-1], 16)
                self.byte[self.text[i]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = sp.id_to_piece(i).replace(MARK, " ")
                self.text[i] = piece
                if "\n" in piece or " " in piece.lstrip(" "):
                    raise ValueError(f"piece {piece!r} goes on over a blank or line break")
                self.ids[piece] = (i, -sharpness * math.log(rank + rank_shift))
                rank += 1
        self.longest = max(map(len, self.ids))
        self.is_byte = np.array([t.__class__ is int for t in self.text])
        self.hashed()

    def edges(self, segment: str, end: int) -> Iterator[tuple[int, tuple[int, ...], float]]:
        """(start, ids, log weight) of the pieces of a segment that end at a place."""
        one = False
        for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
            if found := self.ids.get(segment[start:end]):
                yield start, (found[0],), found[1]
                one |= start == end - 1
        if not one:
            raw = self.bytes_of(ord(segment[end - 1]))
            yield end - 1, raw, len(raw) * math.log(BYTE_WEIGHT)

    def bytes_of(self, point: int) -> tuple[int, ...]:
        return tuple(self.byte[b] for b in chr(point).encode("utf-8", "surrogatepass"))

    def hashed(self) -> None:
        """Sorted hashes of the pieces with their ids and weights, and a table that finds most of them at once."""
        points = {p: np.frombuffer(p.encode("utf-32-le"), np.uint32).astype(np.uint64) + _U(1) for p in self.ids}
        keys = np.array([(c[::-1] * _POWERS[: len(c)]).sum(dtype=np.uint64) for c in points.values()], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.key_ids = np.array([i for i, _ in self.ids.values()], np.int32)[order]
        self.key_weights = np.array([w for _, w in self.ids.values()])[order]
        slots = self.slot(self.keys)
        self.at_slot = np.full(1 << 20, -1, np.int32)
        self.at_slot[slots] = np.arange(len(slots))
        self.shared_slot = np.bincount(slots, minlength=1 << 20) > 1

    def found(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the hashes are pieces', the places of those pieces in the sorted keys)."""
        slots = self.slot(keys)
        at = self.at_slot[slots]
        right = self.keys[at] == keys
        others = np.flatnonzero(~right & self.shared_slot[slots])
        at[others] = np.minimum(np.searchsorted(self.keys, keys[others]), len(self.keys) - 1)
        right[others] = self.keys[at[others]] == keys[others]
        hit = np.flatnonzero(right)
        return hit, at[hit]

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(44)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; runs of bytes are read as UTF-8."""
        if not self.is_byte[ids].any():
            return "".join(map(self.text.__getitem__, ids.tolist()))
        out, raw = [], bytearray()
        for t in map(self.text.__getitem__, ids.tolist()):
            if t.__class__ is int:
                raw.append(t)
            else:
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(t)
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)


@lru_cache(2)
def pieces_of(path: str, rank_shift: float = RANK_SHIFT, sharpness: float = SHARPNESS) -> Pieces:
    """A vocabulary, read once by each Python worker."""
    return Pieces(path, rank_shift, sharpness)


def forward(pieces: Pieces, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The forward tables of segments, longest first: (node at the end of each, first, share, before, piece).

    Segment k takes a node for its start and one for each of its characters; first is the first edge of each node. The
    other arrays have an edge each, in the order of the nodes where edges end: cumulative share among the node's edges,
    the node where the edge starts (-1 if that is a segment's start), and the piece's id, or -1 - c for the bytes of
    character c.
    """
    sizes = np.array([len(s) for s in segments], np.int64)
    base = np.cumsum(sizes + 1) - sizes - 1
    total = int(base[-1] + sizes[-1] + 1)
    place = np.arange(total) - np.repeat(base, sizes + 1)
    point = np.zeros(total, np.uint64)
    point[place > 0] = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
    point += _U(1)
    at = np.flatnonzero(place > 0)
    key, edges, alone = np.zeros(len(at), np.uint64), [], np.zeros(total, bool)
    for n in range(1, pieces.longest + 1):
        held = place[at] >= n
        at, key = at[held], key[held] + point[at[held] - (n - 1)] * _POWERS[n - 1]
        hit, k = pieces.found(key)
        node = at[hit]
        edges.append((node, np.full(len(node), n), pieces.key_weights[k], pieces.key_ids[k]))
        if n == 1:
            alone[node] = True
    bare = np.flatnonzero((place > 0) & ~alone)
    c = point[bare].astype(np.int64) - 1
    edges.append((bare, np.ones(len(bare), np.int64), math.log(BYTE_WEIGHT) * (1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)), -1 - c))
    node, back, weight, piece = (np.concatenate(x) for x in zip(*edges, strict=True))

    order = np.argsort(node * (pieces.longest + 1) + back)
    kept = node[order], back[order], piece[order].astype(np.int32)
    # edges by the place where they end, so that a place's sums are made for all segments at once
    by_place = np.argsort(place[kept[0]].astype(np.uint16), kind="stable")
    node, back, weight = kept[0][by_place], kept[1][by_place], weight[order[by_place]]
    group = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    count = np.diff(np.append(group, len(node)))
    steps = np.searchsorted(place[node[group]], np.arange(1, int(sizes[0]) + 2))
    alpha, share = np.zeros(total), np.zeros(len(node))
    for g, h in zip(steps, steps[1:], strict=False):
        s, e = group[g], group[h] if h < len(group) else len(node)
        own, n = group[g:h] - s, count[g:h]
        paths = weight[s:e] + alpha[node[s:e] - back[s:e]]
        top = np.maximum.reduceat(paths, own)
        so_far = np.cumsum(np.exp(paths - np.repeat(top, n)))
        ends = so_far[own + n - 1]
        before = np.append(0.0, ends[:-1])
        alpha[node[s:e][own]] = top + np.log(ends - before)
        share[s:e] = (so_far - np.repeat(before, n)) / np.repeat(ends - before, n)
    share[group + count - 1] = 1.0

    node, back, piece = kept
    shares = np.empty(len(share))
    shares[by_place] = share
    first = np.cumsum(np.bincount(node, minlength=total))
    first = np.append(0, first[:-1])
    before = np.where(place[node] == back, -1, node - back)
    return base + sizes, first, shares, before, piece


class LongSegment:
    """The forward table of one segment, place by place: the edges that end at place n are first[n - 1]..first[n] - 1.

    share holds cumulative shares of a place's edges, back their lengths, piece as forward() has it.
    """

    def __init__(self, pieces: Pieces, segment: str):
        known, most = pieces.ids.get, pieces.longest
        alpha = array("d", bytes(8 * (len(segment) + 1)))
        self.first, self.share, self.back, self.piece = array("q", [0]), array("d"), array("H"), array("i")
        for end in range(1, len(segment) + 1):
            found = [(n, hit) for n in range(1, min(end, most) + 1) if (hit := known(segment[end - n : end]))]
            if not found or found[0][0] > 1:
                c = ord(segment[end - 1])
                found.insert(0, (1, (-1 - c, math.log(BYTE_WEIGHT) * len(chr(c).encode("utf-8", "surrogatepass")))))
            paths = [w + alpha[end - n] for n, (_, w) in found]
            top = max(paths)
            parts = [math.exp(x - top) for x in paths]
            whole, so_far = math.fsum(parts), 0.0
            alpha[end] = top + math.log(whole)
            for (n, (i, _)), part in zip(found, parts, strict=True):
                so_far += part
                self.share.append(so_far / whole)
                self.back.append(n)
                self.piece.append(i)
            self.first.append(len(self.share))

    def drawn(self, uniform: Callable[[int, int], np.ndarray]) -> np.ndarray:
        """Pieces in order; uniform(a, b) gives the draws a..b-1."""
        first, share, back, piece = self.first, self.share, self.back, self.piece
        at, out, step = len(first) - 1, array("i"), 1 << 14
        while at:
            for u in uniform(len(out), len(out) + step).tolist():
                edge = bisect_right(share, u, first[at - 1], first[at] - 1)
                out.append(piece[edge])
                at -= back[edge]
                if not at:
                    break
        return np.array(out, np.int32)[::-1]


class Sampler:
    """Draws segmentations of batches of rows; holds the forward tables of segments as flat arrays.

    Node n of the arrays is a place of a segment, its edges start at first[n], and share rises to 1 over them.
    """

    def __init__(self, path: str, seed: int = SEED, most: int = CACHE_SEGMENTS, rank_shift: float = RANK_SHIFT, sharpness: float = SHARPNESS):
        self.pieces, self.seed, self.most = pieces_of(path, rank_shift, sharpness), seed, most
        self._clear()

    def _clear(self) -> None:
        self.last: dict[str, int] = {}  # the node at a segment's end
        self.nodes = self.edges = 0
        self.first = np.zeros(0, np.int64)
        self.share, self.before, self.piece = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int32)

    @staticmethod
    def _joined(old: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
        """old with new from place `used` on; room doubles when it ends."""
        if used + len(new) > len(old):
            old = np.concatenate([old[:used], np.empty(max(used, 2 * len(new)), old.dtype)])
        old[used : used + len(new)] = new
        return old

    def _add(self, segments: list[str], sizes: np.ndarray) -> None:
        order = np.argsort(-sizes, kind="stable")
        segments, upto = [segments[i] for i in order], np.cumsum(sizes[order] + 1)
        at = 0
        while at < len(segments):
            full = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PLACES))
            end = max(at + 1, full)
            last, first, share, before, piece = forward(self.pieces, segments[at:end])
            self.last.update(zip(segments[at:end], (last + self.nodes).tolist(), strict=True))
            self.first = self._joined(self.first, self.nodes, first + self.edges)
            self.share = self._joined(self.share, self.edges, share)
            self.before = self._joined(self.before, self.edges, np.where(before < 0, -1, before + self.nodes))
            self.piece = self._joined(self.piece, self.edges, piece)
            self.nodes, self.edges, at = self.nodes + len(first), self.edges + len(share), end

    def step(self, node: np.ndarray, draw: np.ndarray) -> np.ndarray:
        """The edge that each draw means at its node: the first whose share is above it."""
        edge = self.first[node]
        on = np.flatnonzero(self.share[edge] <= draw)
        while len(on):
            edge[on] += 1
            on = on[self.share[edge[on]] <= draw[on]]
        return edge

    def draws(self, keys: np.ndarray, segment: np.ndarray, draw: int | np.ndarray) -> np.ndarray:
        """Uniform numbers in [0, 1), the same for the same seed, key, segment and draw."""
        with np.errstate(over="ignore"):
            x = keys.view(np.uint64) * _U(0x9E3779B97F4A7C15) + segment.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)
            x = x + _U(self.seed * 0x165667B19E3779F9 & 0xFFFFFFFFFFFFFFFF) + np.asarray(draw, np.uint64) * _U(0x27D4EB2F165667C5)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> _U(shift))) * _U(factor)
            x ^= x >> _U(31)
        return (x >> _U(11)).astype(np.float64) / (1 << 53)

    def __call__(self, keys: list[int | None], texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        rows = [_SEGMENT.findall(t) for t in texts]
        flat = [s for r in rows for s in r]
        distinct = set(flat)
        missing, long = list(distinct.difference(self.last)), []
        if missing:
            sizes = np.fromiter(map(len, missing), np.int64, len(missing))
            if len(self.last) + len(missing) > self.most or self.nodes + int(sizes.sum()) > CACHE_PLACES:
                self._clear()
                missing = list(distinct)
                sizes = np.fromiter(map(len, missing), np.int64, len(missing))
            if sizes.max() > LONG:
                huge = {missing[i] for i in np.flatnonzero(sizes > LONG)}
                long = [i for i, s in enumerate(flat) if s in huge]
                missing, sizes = [s for s in missing if s not in huge], sizes[sizes <= LONG]
            self._add(missing, sizes)
        counts = np.array([len(r) for r in rows], np.int64)
        start = np.cumsum(counts) - counts
        key = np.repeat(np.array([k or 0 for k in keys], np.int64), counts)
        number = np.arange(len(flat)) - np.repeat(start, counts)
        live = np.delete(np.arange(len(flat)), long)
        node = np.fromiter(map(self.last.__getitem__, [flat[i] for i in live] if long else flat), np.int64, len(live))
        drawn, edges, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while len(live):
            edge = self.step(node, self.draws(key[live], number[live], step))
            drawn.append(live)
            edges.append(edge)
            node = self.before[edge]
            live, node = live[node >= 0], node[node >= 0]
            step += 1
        alone = {i: LongSegment(self.pieces, flat[i]).drawn(lambda a, b, i=i: self.draws(key[i : i + 1], number[i : i + 1], np.arange(a, b))) for i in long}
        turn = np.repeat(np.arange(len(drawn)) - 1, [len(d) for d in drawn])
        drawn, edges = np.concatenate(drawn), np.concatenate(edges)
        pieces = np.bincount(drawn, minlength=len(flat))
        for i, found in alone.items():
            pieces[i] = len(found)
        ends = np.cumsum(pieces)
        ids = np.empty(ends[-1] if len(flat) else 0, np.int32)
        ids[ends[drawn] - 1 - turn] = self.piece[edges]
        for i, found in alone.items():
            ids[ends[i] - len(found) : ends[i]] = found
        upto = np.concatenate([[0], np.cumsum(pieces)])[np.concatenate([start, [len(flat)]])]
        if (ids < 0).any():
            own = {int(x): self.pieces.bytes_of(-1 - int(x)) for x in np.unique(ids[ids < 0])}
            sizes = np.ones(len(ids), np.int64)
            for x, raw in own.items():
                sizes[ids == x] = len(raw)
            to = np.concatenate([[0], np.cumsum(sizes)])
            out = np.repeat(ids, sizes)
            for x, raw in own.items():
                for k, b in enumerate(raw):
                    out[to[:-1][ids == x] + k] = b
            ids, upto = out, to[upto]
        return [ids[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]


def encode(docs: DataFrame, model: str | None = None, seed: int = SEED, rank_shift: float = RANK_SHIFT, sharpness: float = SHARPNESS) -> DataFrame:
    """(doc_id, text, ids): ids are little-endian unsigned 32-bit integers in a binary column.

    The piece of rank r weighs (r + rank_shift) ** -sharpness: a larger sharpness keeps nearer to the likeliest pieces.
    """
    path = model or model_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sample = Sampler(path, seed, rank_shift=rank_shift, sharpness=sharpness)
        for batch in batches:
            for part in parts_of(batch, 1, BATCH_ROWS):
                texts = part.column(1).to_pylist()
                found = sample(part.column(0).to_pylist(), [t or "" for t in texts])
                ids = [None if t is None else i.astype("<u4").tobytes() for t, i in zip(texts, found, strict=True)]
                yield pa.record_batch([*part.columns, pa.array(ids, pa.binary())], names=["doc_id", "text", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string, ids binary")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """encoded (.., ids, ..) plus decoded, the text that the ids stand for."""
    from pyspark.sql import types as T

    path = model or model_path()
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    at = encoded.columns.index("ids")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pieces = pieces_of(path)
        for batch in batches:
            for part in parts_of(batch, at, BATCH_ROWS):
                texts = [None if b is None else pieces.decode(np.frombuffer(b, "<u4")) for b in part.column(at).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, lossless) for each document."""
    out = decode(encode(table(spark, sf_dir, "documents")))
    n = (F.octet_length("ids") / 4).cast("long").alias("n_pieces")
    return out.select("doc_id", n, F.crc32("ids").alias("ids_crc32"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))
