"""Byte-pair encoding and decoding with a public vocabulary file.

The text is cut at the special tokens and then by the pre-tokenizer's pattern;
each piece is encoded by a priority queue of merge ranks over a doubly linked
list of symbols. A merge makes queue entries stale; they are recognised by
their positions and skipped when they come up. Decoding concatenates the
vocabulary's byte strings.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import map_batches, read, texts_of, whole_text

#: Pre-tokenizer pattern of byte-level vocabularies (fixed value of the format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The pattern's white space.
WHITE = frozenset(regex.findall(r"\s", "".join(map(chr, range(0x3001)))))

#: A space between two characters that are no white space.
SURE = regex.compile(r"(?<=\S) (?=\S)")

#: Entries of one generation of a worker's caches, and the longest text kept.
CACHE_ENTRIES, CACHE_CHARS = 250_000, 48


class Loose(Exception):
    """A space beside other white space."""


class Recent(dict):
    """A bounded cache: a full generation becomes the old one, and entries found there are kept on."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, text: str) -> bytes:
        out = self.old.get(text)
        if out is None:
            out = self.make(text)
            if len(text) > CACHE_CHARS:
                return out
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        self[text] = out
        return out


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, by the byte-level rule: printable
    Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = byte_alphabet()
        raw = lambda s: bytes(back[c] for c in s)
        vocab = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.strings = [b""] * size
        for s, i in [*vocab.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.strings[i] = s
        self.table = np.array(self.strings, object)
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        # left id -> right id -> rank, rank -> new id, byte -> byte -> rank: small integers for the hot loop
        self.ranks, self.merged = [{}] * size, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (raw(s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
            self.ranks[vocab[a]] = self.ranks[vocab[a]] or {}
            self.ranks[vocab[a]].setdefault(vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.first = [[self.ranks[a].get(b, -1) for b in self.byte_id] for a in self.byte_id]
        self.pieces = regex.compile(PATTERN)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.piece = Recent(self.whole)
        #: A word and the space before it.
        self.word = Recent(self.spaced)

    def whole(self, piece: str) -> bytes:
        return b"".join([self.packed[i] for i in self.symbols(piece.encode())])

    def spaced(self, word: str) -> bytes:
        """Ids of a word and the space before it, which starts a piece; letters alone are one piece."""
        if not word.isalpha():
            if not word or word[0] in WHITE or word[-1] in WHITE:
                raise Loose
            first, *rest = self.pieces.findall(" " + word)
            if rest:
                return self.word[first[1:]] + b"".join([self.piece[p] for p in rest])
        return self.whole(" " + word)

    def symbols(self, data: bytes) -> list[int]:
        """Ids of one piece: merges by rank, leftmost first among equal ranks.

        A queue entry is rank << bits | position. It is stale, and skipped, unless
        the pair that now starts at the position still has that entry.
        """
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        first, ranks, merged, push, pop = self.first, self.ranks, self.merged, heapq.heappush, heapq.heappop
        bits = n.bit_length()
        mask = (1 << bits) - 1
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        found, queue = [-1] * n, []  # found: the entry of the pair that starts here
        for i, (a, b) in enumerate(zip(data, data[1:])):
            r = first[a][b]
            if r >= 0:
                e = found[i] = r << bits | i
                queue.append(e)
        heapq.heapify(queue)
        while queue:
            e = pop(queue)
            i = e & mask
            if found[i] != e:
                continue
            j = nxt[i]
            k = nxt[i] = nxt[j]
            found[j] = ids[j] = found[i] = -1
            new = ids[i] = merged[e >> bits]
            if k < n:
                prv[k] = i
                r = ranks[new].get(ids[k])
                if r is not None:
                    e = found[i] = r << bits | i
                    push(queue, e)
            h = prv[i]
            if h >= 0:
                r = ranks[ids[h]].get(new)
                if r is None:
                    found[h] = -1
                else:
                    e = found[h] = r << bits | h
                    push(queue, e)
        return [s for s in ids if s >= 0]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A piece holds a space only as its first character or among white space,
        so a space between two characters that are no white space always starts
        a piece: the text is looked up by what stands between such spaces.
        """
        parts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.packed[self.special[part]])
            elif part:
                out += self.of_words(part)
        return b"".join(out)

    def of_words(self, part: str) -> list[bytes]:
        """Ids of a part by the words between its spaces, or between the sure ones if some are loose."""
        piece, word, cut = self.piece, self.word, self.pieces.findall
        try:
            first, *rest = part.split(" ")
            if rest and (not first or first[-1] in WHITE):
                raise Loose
            return [piece[p] for p in cut(first)] + [word[w] for w in rest]
        except Loose:
            first, *rest = SURE.split(part)
            last = cut(" " + rest.pop()) if rest and rest[-1][-1] in WHITE else []
            return [piece[p] for p in cut(first)] + [word[w] for w in rest] + [piece[p] for p in last]

    def decode(self, ids: bytes) -> str:
        """The vocabulary's strings one after the other; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(self.table[np.frombuffer(ids, "<u4")].tolist()).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec a process: a Python worker serves many tasks."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_decode(docs: DataFrame, carry: list[str], text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``carry`` with ``ids`` (binary: little-endian unsigned 32-bit) and ``decoded`` for each row.

    A null text counts as the empty text, which has no ids. Every row gives one
    row, repeated rows too; an empty table gives an empty one. Only ``carry`` and
    the text are read, so other columns may have any name. ``vocabulary``: the
    vocabulary file; None takes the installed public one, found by each worker.
    The file must lie at that path on every executor.
    """
    keep = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    inner = [f"c{i}" for i in range(len(carry))]

    def make():
        c = codec(vocabulary or default_vocabulary())

        def batch(b):
            ids = [c.encode(t) for t in texts_of(b, "t")]
            return [pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.string())]

        return batch

    out = map_batches(docs.select(*keep, whole_text(text).alias("t")), inner, "ids binary, decoded string", make)
    return out.select(*[F.col(i).alias(c) for i, c in zip(inner, carry)], "ids", "decoded")


def op2_bpe(spark, sf_dir):
    """Contract query: encode and decode every document."""
    out = encode_decode(read(spark, sf_dir, "documents"), ["doc_id"])
    return out.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def stage_bpe(spark, docs, sf_dir):
    """Pipeline stage: the documents' tokens, with the digests of ids and decoded text."""
    out = encode_decode(docs, ["doc_id", "lang", "source", "n_chars"])
    return out.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        "ids",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
