"""Exact token counts at every prefix of a text, for a byte-level BPE vocabulary file.

A text is taken apart as the tokenizer does it: at special strings, then into pieces by the
vocabulary's pattern. Inside a piece, prefix dynamic programming finds for each prefix its count and
its last token: of the tokens that end there, the one that is compatible with the last token of what
lies before it (the two alone encode to just these two). That one is unique, so no merges have to
be replayed, and counts of a piece serve all its prefixes. Pieces repeat, so each worker keeps the
counts of those it has met, up to `CACHE` of them, and starts anew beyond.

`prefix_counts` holds a count for every prefix in code points; `count`, `longest_prefix` and
`cut` answer questions from it without encoding again. Prefix counts may fall as well as rise.

Defined results: null is an empty text with 0 tokens; nothing is truncated or padded; no begin, end
or other special tokens are added; a special string inside a text is one token.
"""

from __future__ import annotations

import json
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

CACHE = 1 << 19

# Fixed value: the pattern of the vocabulary's byte-level pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixEncoder(dict):
    """Maps a piece (str) to its token count; a missing one is worked out."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in spec["model"]["vocab"]}
        self.tokens = {raw[t]: i for t, i in spec["model"]["vocab"].items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank = {(raw[a], raw[b]): k for k, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.tokens))
        special = [t["content"] for t in spec.get("added_tokens", ()) if t.get("special")]
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.special_set = set(special)
        self.pieces = regex.compile(PATTERN).findall
        self.made = {a + b: (k, a, b) for (a, b), k in self.rank.items()}
        self.whole: dict[bytes, bool] = {}
        self.fits: dict[tuple[bytes, bytes], bool] = {}

    def merged(self, text: bytes) -> list[bytes]:
        """The tokens by their merges, lowest rank first; for short strings."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def reachable(self, token: bytes) -> bool:
        """Whether a token's own bytes encode to it."""
        got = self.whole.get(token)
        if got is None:
            got = self.whole[token] = self.merged(token) == [token]
        return got

    def compatible(self, a: bytes, b: bytes) -> bool:
        """Whether `a` followed by `b` stays so: undo the merges of both, latest first; no merge across
        the border may come before the one just undone (or with it, where it stands further left)."""
        limit, rank, made = 1 << 60, self.rank, self.made
        while True:
            if rank.get((a, b), 1 << 60) < limit:
                return False
            left, right = made.get(a), made.get(b)
            if left is not None and (right is None or left[0] > right[0]):
                limit, a = left[0], left[2]
            elif right is not None:
                limit, b = right[0] + 1, right[1]
            else:
                return True

    def prefixes(self, piece: bytes) -> list[int]:
        """The token count of each prefix of the piece in bytes, from the empty one on."""
        last, count, tokens, most, fits = [b""], [0], self.tokens, self.longest, self.fits
        if len(fits) > CACHE:
            fits.clear()
        for end in range(1, len(piece) + 1):
            for start in range(max(0, end - most), end):
                token = piece[start:end]
                if token in tokens:
                    if start:
                        pair = last[start], token
                        fit = fits.get(pair)
                        if fit is None:
                            fit = fits[pair] = self.compatible(*pair)
                    else:
                        fit = self.reachable(token)
                    if fit:
                        last.append(token)
                        count.append(count[start] + 1)
                        break
            else:
                raise ValueError(f"no token ends at {end} of {piece!r}")
        return count

    def __missing__(self, piece: str) -> int:
        if len(self) > CACHE:
            self.clear()
        n = self[piece] = self.prefixes(piece.encode())[-1]
        return n

    def parts(self, text: str) -> list[str]:
        """The text between special strings, and these."""
        return self.special.split(text) if self.special else [text]

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return sum(map(self.__getitem__, self.pieces(text)))
        return sum(1 if p in self.special_set else sum(map(self.__getitem__, self.pieces(p))) for p in self.parts(text))

    def prefix_counts(self, text: str) -> list[int]:
        """The count of every prefix in code points, from the empty one on."""
        out, before, ahead = [0], 0, ""
        for part in self.parts(text):
            if part in self.special_set:
                # A prefix that ends inside a special string holds ordinary text, which joins what is ahead of it.
                without = before - self.count(ahead)
                out += [without + self.count(ahead + part[:k]) for k in range(1, len(part))] + [before + 1]
                before += 1
                continue
            ahead = part
            for piece in self.pieces(part):
                if len(piece) > 2 and piece[0] == "'":
                    # Cut short, a contraction falls apart: its prefix is no piece of its own.
                    own = [0] + [self.count(piece[:k]) for k in range(1, len(piece))] + [self[piece]]
                else:
                    at = accumulate((len(c.encode()) for c in piece), initial=0)
                    by_byte = self.prefixes(piece.encode())
                    own = [by_byte[k] for k in at]
                out += [before + n for n in own[1:]]
                before += own[-1]
        return out


_encoders: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = PrefixEncoder(path)
    return _encoders[path]


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`row` (a struct of all input columns but the text), n_bytes and n_tokens."""
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                                              pa.array([enc.count(t) for t in texts], pa.int64())], names=["row", "n_bytes", "n_tokens"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != text]).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, StructType([StructField("row", rows.schema["row"].dataType), StructField("n_bytes", LongType()),
                                            StructField("n_tokens", LongType())]))


def with_prefix_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`row` (a struct of all input columns) and prefix_counts, an array with one entry more than code points."""
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for k in range(batch.num_rows):  # row by row: the counts take more room than the text
                counts = enc.prefix_counts(batch.column(1)[k].as_py() or "")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([counts], pa.list_(pa.int32()))], names=["row", "prefix_counts"])

    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, StructType([StructField("row", rows.schema["row"].dataType), StructField("prefix_counts", ArrayType(IntegerType()))]))


def count(prefix_counts: str | Column, n_chars: int | Column) -> Column:
    """Tokens of the first `n_chars` code points."""
    return F.get(prefix_counts, n_chars if isinstance(n_chars, Column) else F.lit(n_chars))


def longest_prefix(prefix_counts: str | Column, budget: int) -> Column:
    """Code points of the longest prefix of at most `budget` tokens."""
    c = F.col(prefix_counts) if isinstance(prefix_counts, str) else prefix_counts
    fits = F.transform(c, lambda n, i: F.when(n <= budget, i))
    return F.array_max(fits)


def cut(text: str | Column, prefix_counts: str | Column, budget: int) -> Column:
    """The text up to that prefix."""
    return F.substring(F.col(text) if isinstance(text, str) else text, F.lit(1), longest_prefix(prefix_counts, budget))
