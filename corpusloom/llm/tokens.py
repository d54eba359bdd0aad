"""Encoding of the whole corpus with a public byte-pair vocabulary (problem 8).

Prefix dynamic programming. For a run of bytes every prefix has exactly one token that the
merges can leave as its last: the one that ends there, and that the last token of what
comes before it doesn't merge into. So one pass over the prefixes stores that token for
each, and the encoding is read off backwards. As prefixes keep their tokens, bytes can be
appended exactly, and after an edit only the tokens from the edit on are found anew, until
they fall in with the old ones.

Texts are cut by the vocabulary's own pattern first; pieces come again and again, so each
task keeps the encodings of the pieces it has met.

Defined results: a null or an empty text has no tokens, an empty list of ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import spread, table

#: Fixed value: the pattern that cuts a text into pieces, as the vocabulary's publishers give it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pieces a task keeps; met again after that, a piece is encoded anew.
KEPT = 500_000
#: Characters behind a piece that its cut may depend on, by the pattern.
AHEAD = 3


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """Token's bytes → id; the id is also the rank of its merge."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PrefixEncoder:
    """Encodes runs of bytes by the last token of each prefix."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)
        self._whole: dict[bytes, bool] = {}
        self._apart: dict[tuple[bytes, bytes], bool] = {}

    def _merged(self, data: bytes) -> list[bytes]:
        """The merges carried out one by one; for a token or two only, to learn what may stand."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min((x for x in ranked if x[0] is not None), default=None)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def _stands(self, token: bytes) -> bool:
        """True if the merges of the token's own bytes end in it."""
        if (known := self._whole.get(token)) is None:
            known = self._whole[token] = self._merged(token) == [token]
        return known

    def _beside(self, a: bytes, b: bytes) -> bool:
        """True if the merges leave the two tokens apart, as they are."""
        if (known := self._apart.get((a, b))) is None:
            if len(self._apart) > KEPT:
                self._apart.clear()
            known = self._apart[a, b] = self._merged(a + b) == [a, b]
        return known

    def last_tokens(self, data: bytes, last: list[bytes] | None = None) -> list[bytes]:
        """The last token of each prefix; ``last`` holds those of the prefixes already known."""
        last = last if last is not None else []
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = data[start:end]
                if token in self.ranks and self._stands(token) and (start == 0 or self._beside(last[start - 1], token)):
                    last.append(token)
                    break
            else:
                raise ValueError(f"the vocabulary has no token that ends in {data[end - 1 : end]!r}")
        return last

    def read_off(self, last: list[bytes]) -> list[int]:
        """Ids of the whole run, from the last tokens of its prefixes."""
        ids, end = [], len(last)
        while end:
            ids.append(self.ranks[last[end - 1]])
            end -= len(last[end - 1])
        return ids[::-1]

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None and self._stands(data) else self.read_off(self.last_tokens(data))

    def appended(self, last: list[bytes], data: bytes, more: bytes) -> list[bytes]:
        """Last tokens of ``data + more``; those of ``data`` hold as they are."""
        return self.last_tokens(data + more, [*last])

    def edited(self, last: list[bytes], data: bytes, start: int, end: int, new: bytes) -> tuple[bytes, list[bytes]]:
        """The run with ``data[start:end]`` replaced, and its last tokens.

        Prefixes before the edit keep theirs. Behind it tokens are found anew until as many
        prefixes in a row agree with the old ones as the longest token has bytes; from there
        on nothing can differ."""
        changed = data[:start] + new + data[end:]
        out, shift, same = last[:start], len(changed) - len(data), 0
        while len(out) < len(changed):
            at = len(out)
            self.last_tokens(changed[: at + 1], out)
            old = at - shift
            same = same + 1 if old >= end and last[old] == out[at] else 0
            if same >= self.longest:
                return changed, out + last[old + 1 :]
        return changed, out


class TextEncoder:
    """Encodes texts piece by piece."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.encoder = PrefixEncoder(ranks)
        self.pieces, self.cuts = regex.compile(PATTERN).findall, regex.compile(PATTERN).finditer
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if not text:
            return ids
        known, extend = self.known, ids.extend
        for piece in self.pieces(text):
            try:
                extend(known[piece])
            except KeyError:
                if len(known) > KEPT:
                    known.clear()
                known[piece] = found = self.encoder.encode(piece.encode("utf-8", "surrogatepass"))
                extend(found)
        return ids


    def encode_piece(self, piece: str) -> list[int]:
        if (found := self.known.get(piece)) is None:
            if len(self.known) > KEPT:
                self.known.clear()
            found = self.known[piece] = self.encoder.encode(piece.encode("utf-8", "surrogatepass"))
        return found

    def edited(self, pieces: list[str], start: int, end: int, new: str) -> list[str]:
        """The pieces of a text with ``[start:end]`` replaced by ``new``, from its pieces before.

        A piece depends on what stands from its start to AHEAD characters behind its end, so
        those that end so far before the edit stay; then the text is cut anew until a cut
        falls in with an old one behind the edit, from where on the old pieces stay."""
        kept = at = 0
        while kept < len(pieces) and at + len(pieces[kept]) + AHEAD <= start:
            at += len(pieces[kept])
            kept += 1
        old, places = at, {}
        for k in range(kept, len(pieces)):
            if old >= end:
                places[old] = k
            old += len(pieces[k])
        rest = "".join(pieces[kept:])
        changed, shift = rest[: start - at] + new + rest[end - at :], len(new) - (end - start)
        out = pieces[:kept]
        for m in self.cuts(changed):
            if m.start() + at >= start + len(new) and (k := places.get(m.start() + at - shift)) is not None:
                return out + pieces[k:]
            out.append(m.group())
        return out

    def ids(self, pieces: list[str]) -> list[int]:
        return [i for piece in pieces for i in self.encode_piece(piece)]


def encoded(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row; the vocabulary, of a fixed size, is broadcast."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(ranks.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[key, "ids"])

    return spread(df.select(key, text)).mapInArrow(work, f"{key} {df.schema[key].dataType.simpleString()}, ids array<int>")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document by byte_bpe_50k, without special tokens."""
    return encoded(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document with its title and a blank line before its text. The text
    is appended to the title's pieces, so what the title gave is kept where it holds; a
    null title or text counts as empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "title", "text")
    ranks = spark.sparkContext.broadcast(read_ranks())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(ranks.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = []
                for title, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    head = f"{title or ''}\n\n"
                    ids.append(encoder.ids(encoder.edited(encoder.pieces(head), len(head), len(head), text or "")))
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.fromiter((i for x in ids for i in x), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])

    return spread(docs).mapInArrow(work, "doc_id long, ids array<int>")
