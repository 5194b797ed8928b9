"""Hierarchical multi-length packing of tokenised documents.

A document's ids are its text's tokens and then one end id. Inside every partition, groups of a bounded number of tokens
are packed on their own, in five steps: whole windows of the longest tier are cut off first; each rest is routed to the
smallest tier that holds it; each tier's windows are filled best fit first, longest rest first; gaps of longer windows
are filled from shorter tiers, where the last filler may be cut so that the window ends full; what fills no window of
the shortest tier ends in sequences whose lengths are powers of two. So no sequence needs padding. Then each tier's
sequences are dealt to step groups of equal token counts, serpentine by their number of pieces.

There is no shuffle: a lost task is run again over the same split and gives the same sequences and ids.

Defined cases: null text is empty and has the end id alone; null doc_id stays null; repeated rows are packed one by one;
other columns take no part.
"""

from __future__ import annotations

import bisect
import re
import struct
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnfield.llm._shared import table

WINDOW = 1024
TIERS = (1024, 512, 256, 128)
STEP_TOKENS = 16 * 1024
GROUP_TOKENS = 2_000_000
END_ID = 0
#: Distinct words that a task's cache holds, at some 200 bytes each.
CACHE_WORDS = 1_000_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

_WS = "[\t-\r \x85\xa0  -     　]"
_RUN = re.compile(f"{_WS} (?:{_WS}|\\Z)")
#: Letters that every tokenizer's tables know; a word of them, a mark, a line break and a further word are units each.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
_UNITS = re.compile(f"({_LETTERS})(?:([.,;:!?]?)(\n?)({_LETTERS})?)").fullmatch
_PAIRS = tuple(c + " " for c in "\t\n\x0b\x0c\r ")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Byte-level BPE of whole texts, by way of a bounded cache of words.

    The vocabulary's pre-tokenizer starts a new unit at a blank unless white space stands on both sides of it, so texts
    without such runs are encoded blank by blank, each distinct word once. Other texts, and those that hold a special
    token's string, are encoded in one piece.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.most, self.cache = Tokenizer.from_file(path), cache_words, {}
        self.tails: dict[str, bytes] = {}
        self.starts = {i for t, i in self.model.get_vocab().items() if t[0] == "\u0120"}
        self.special = tuple(t.content for t in self.model.get_added_tokens_decoder().values())

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(i)}I", *i) for i in [e.ids for e in found]]

    def whole(self, text: str) -> bytes:
        return self._encode([text])[0]

    def _learn(self, missing: set[str]) -> None:
        """Puts the ids of words into the cache: plain words in one go, words with marks from their units."""
        cache, made, plain, others = self.cache, [], set(), []
        for w in missing:
            found = _UNITS(w)
            if found is None:
                others.append(w)
            elif found[1] == w:
                plain.add(w)
            else:
                made.append((w, found.groups()))
                if found[1] not in cache:
                    plain.add(found[1])
        words = list(plain)
        if words:
            ids = self.model.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids
            raw, starts = array("I", ids).tobytes(), self.starts
            at = [4 * i for i, t in enumerate(ids) if t in starts]
            if len(at) == len(words):
                at.append(len(raw))
                for w, a, b in zip(words, at, at[1:], strict=False):
                    cache[w] = raw[a:b]
            else:  # a vocabulary whose units don't start with the blank
                others += words
        cache.update(zip(others, self._encode([" " + w for w in others]), strict=True))
        for w, (first, *rest) in made:
            cache[w] = cache[first] + b"".join([self.tail(u) for u in rest if u])

    def tail(self, unit: str) -> bytes:
        """The ids of a unit that no blank goes before."""
        if unit not in self.tails:
            self.tails[unit] = self.whole(unit)
        return self.tails[unit]

    def __call__(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        runs = any(p in text for p in _PAIRS) if text.isascii() else True
        if runs and _RUN.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        words = text.split(" ")
        first, words = words[0], words[1:]
        cache = self.cache
        missing = set(words).difference(cache)
        if missing:
            if len(cache) + 2 * len(missing) > self.most:  # a word and its first unit
                cache.clear()
                self.tails.clear()
                missing = set(words)
            self._learn(missing)
        return (self.whole(first) if first else b"") + b"".join([cache[w] for w in words])


def powers(n: int) -> list[int]:
    """n as falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_group(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (tier, [(document, start, length)]) that hold every token of the documents once, none padded."""
    top = tiers[0]
    done = [(top, [(d, s, top)]) for d, n in enumerate(lengths) for s in range(0, n - top + 1, top)]
    routed: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}  # rests (length, document, start), rising
    for d, n in enumerate(lengths):
        if rest := n % top:
            routed[min(t for t in tiers if t >= rest)].append((rest, d, n - rest))
    for rests in routed.values():
        rests.sort()
    for k, tier in enumerate(tiers):
        gaps: list[tuple[int, int]] = []  # (gap, window), rising
        windows: list[list[tuple[int, int, int]]] = []
        for rest, d, s in reversed(routed[tier]):
            at = bisect.bisect_left(gaps, (rest, -1))
            if at < len(gaps):
                gap, w = gaps.pop(at)
            else:
                gap, w = tier, len(windows)
                windows.append([])
            windows[w].append((d, s, rest))
            if gap > rest:
                bisect.insort(gaps, (gap - rest, w))
        for gap, w in reversed(gaps):
            for lower in tiers[k + 1 :]:
                rests = routed[lower]
                while gap and (at := bisect.bisect_right(rests, (gap, len(lengths), 0))):
                    rest, d, s = rests.pop(at - 1)
                    windows[w].append((d, s, rest))
                    gap -= rest
            lower = next((t for t in tiers[k + 1 :] if routed[t]), None)
            if gap and lower:  # every rest is longer than the gap: cut the shortest
                rest, d, s = routed[lower].pop(0)
                windows[w].append((d, s, gap))
                bisect.insort(routed[min(t for t in tiers if t >= rest - gap)], (rest - gap, d, s + gap))
                gap = 0
        short: list[tuple[int, int, int]] = []
        for pieces in windows:
            if sum(n for _, _, n in pieces) == tier:
                done.append((tier, pieces))
            else:
                short += pieces
        # nothing shorter is left to fill these: their pieces are strung together, and only the end is cut to powers
        for size in [tier] * (sum(n for _, _, n in short) // tier) + powers(sum(n for _, _, n in short) % tier):
            pieces, room = [], size
            while room:
                d, s, n = short.pop()
                take = min(n, room)
                pieces.append((d, s, take))
                room -= take
                if n > take:
                    short.append((d, s + take, n - take))
            done.append((size, pieces))
    return done


def step_groups(sequences: list[tuple[int, list]], step_tokens: int) -> list[int]:
    """A step group for each sequence: full groups of a tier hold step_tokens tokens, and about as many pieces each."""
    out, base = [0] * len(sequences), 0
    for tier in sorted({t for t, _ in sequences}, reverse=True):
        own = sorted((i for i, (t, _) in enumerate(sequences) if t == tier), key=lambda i: -len(sequences[i][1]))
        n = -(-len(own) * tier // step_tokens)
        for at, i in enumerate(own):
            turn, k = divmod(at, n)
            out[i] = base + (n - 1 - k if turn % 2 else k)
        base += n
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece, as SCHEMA says; ids holds the piece's ids as little-endian unsigned 32-bit integers."""
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, end = WordTokenizer(path), END_ID.to_bytes(4, "little")
        base, seq, steps = TaskContext.get().partitionId() << 40, 0, 0

        def flush(ids: list, bufs: list[bytes]) -> pa.RecordBatch:
            nonlocal seq, steps
            packed = pack_group([len(b) // 4 for b in bufs], tiers)
            groups = step_groups(packed, step_tokens)
            cols: list[list] = [[] for _ in range(9)]
            for (tier, pieces), g in zip(packed, groups, strict=True):
                offset = 0
                for d, s, n in pieces:
                    row = (ids[d], s, n, bufs[d][4 * s : 4 * (s + n)], len(bufs[d]) // 4, base + seq, offset, tier, base + steps + g)
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                    offset += n
                seq += 1
            steps += max(groups, default=-1) + 1
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        ids, bufs, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                buf = encode(text.as_py() or "") + end
                ids.append(doc_id)
                bufs.append(buf)
                held += len(buf) // 4
                if held >= group_tokens:
                    yield flush(ids, bufs)
                    ids, bufs, held = [], [], 0
        if ids:
            yield flush(ids, bufs)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"))
    crc = F.crc32("ids").alias("ids_crc32")
    return out.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "tier", "step_group")
