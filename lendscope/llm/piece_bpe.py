"""Encoding and decoding with a sentencepiece model of the merge type, by a prefix table.

Merging joins, as long as any two neighbours make a piece, the pair with the best score,
leftmost first. A row of pieces is the result for its text exactly if each two neighbours in
it are the result for theirs: merges on either side of a border take place as if the rest
were not there, until one crosses it. Hence every prefix of a text has one last piece, and

1. an automaton over all pieces finds the pieces that end at a place;
2. of these, the one that is compatible with the last piece of the prefix before it, is the
   last piece of the prefix that ends here: the table keeps it;
3. the ids are read off the table backwards, from the whole text's last piece.

Two pieces are compatible if their own merges, played in order of score, reach both of them
before a merge across their border comes up.

A character that is no piece is a border for all merges and becomes its UTF-8 bytes. Where
no piece holds a blank sign behind another character, a cut before a blank never falls inside
a piece: texts are then worked off by blank-separated parts, and a worker keeps the ids of
the first parts it meets (which ones changes no result).
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, only, table, text_or_empty

BLANK = "▁"
KEPT = 1_000_000            # bound of the parts whose ids a worker keeps
KEPT_CHARS = 48             # longer ones are not kept
KEPT_PAIRS = 1 << 21        # bound of the compatibility answers that a worker keeps
ROWS, CHARS = 256, 1 << 20  # documents and characters of a result batch
_PARTS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


class _Kept(dict):
    """Answers by key, kept while there is room."""

    def __init__(self, compute, room: int, longest: int | None = None):
        super().__init__()
        self.compute, self.room, self.longest = compute, room, longest

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) < self.room and (self.longest is None or len(key) <= self.longest):
            self[key] = value
        return value


class Pieces:
    """The pieces of a model: encoding by the prefix table, decoding by their texts."""

    def __init__(self, model: str):
        import ahocorasick
        import sentencepiece
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = library.get_piece_size()
        self.score: dict[str, float] = {}
        self.text: list[str] = [""] * size
        self.byte_id: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        self.unknown = library.unk_id()
        plain = []
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif library.is_unused(i):
                raise ValueError("models with unused pieces are not covered")
            elif not (library.is_control(i) or library.is_unknown(i)):
                plain.append(i)
                self.text[i] = piece
                self.score[piece] = library.get_score(i)
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.length = list(map(len, self.text))
        self.plain, self.byte_ids = frozenset(plain), frozenset(self.byte_id.values())
        self.control = frozenset(range(size)) - self.plain - self.byte_ids - {self.unknown}
        self.single = {self.text[i]: i for i in plain if len(self.text[i]) == 1}
        # Decoding: a control piece is nothing, a byte piece its byte, blank signs are spaces.
        self.raw = [self.text[i].replace(BLANK, " ").encode() for i in range(size)]
        for byte, i in self.byte_id.items():
            self.raw[i] = bytes([byte])
        if self.unknown >= 0:
            self.raw[self.unknown] = library.decode([self.unknown]).encode()
        self.bytes_of = [np.array([i], "<i4").tobytes() for i in range(size)]
        self.by_parts = not any(a != BLANK and b == BLANK for t in self.score for a, b in zip(t, t[1:], strict=False))
        self.prefix_blank = library.normalize("a").startswith(BLANK)
        self.line_end = None if "\n" in self.single else self._unlisted("\n")
        self.merges = functools.cache(self._merges)
        self.fits = _Kept(self._fits, KEPT_PAIRS)
        self.parts = _Kept(self._whole, KEPT, KEPT_CHARS)

    # -- compatibility ------------------------------------------------------
    def _merges(self, piece: int) -> tuple[bool, list[tuple[float, str]], list[tuple[float, str]], str, str]:
        """A piece's own merges: whether they end in it; (score, first symbol after) and
        (score, last symbol after) of each; its first and last character."""
        symbols = list(self.text[piece])
        score, heads, tails = self.score, [], []
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            heads.append((best, symbols[0]))
            tails.append((best, symbols[-1]))
        text = self.text[piece]
        return len(symbols) == 1, heads, tails, text[0], text[-1]

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether no merge across the border comes up before both pieces are whole."""
        left, right = pair
        whole, _, ends, _, x = self.merges(left)
        whole_right, starts, _, y, _ = self.merges(right)
        if not (whole and whole_right):
            return False
        i = j = 0
        get = self.score.get
        while True:
            a = ends[i][0] if i < len(ends) else None
            b = starts[j][0] if j < len(starts) else None
            across = get(x + y)
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is None and b is None:
                return True
            if b is None or (a is not None and a >= b):          # equal scores: leftmost first
                x, i = ends[i][1], i + 1
            else:
                y, j = starts[j][1], j + 1

    # -- encoding -----------------------------------------------------------
    def _listed(self, text: str) -> bytes:
        """Ids of a text whose characters are all pieces, by the prefix table."""
        last = array("i", bytes(4 * len(text)))
        fits, length, done = self.fits, self.length, -1
        for end, piece in self.automaton.iter(text):                 # at each end, longest first
            if end != done:
                before = end - length[piece]
                if fits[last[before], piece] if before >= 0 else self.merges(piece)[0]:
                    last[end] = piece
                    done = end
        ids, at = [], len(text) - 1
        while at >= 0:
            ids.append(self.bytes_of[last[at]])
            at -= length[last[at]]
        ids.reverse()
        return b"".join(ids)

    def _unlisted(self, character: str) -> bytes:
        if not self.byte_id:
            return self.bytes_of[self.unknown]
        return b"".join([self.bytes_of[self.byte_id[b]] for b in character.encode()])

    def _whole(self, text: str) -> bytes:
        single, out, first = self.single, [], 0
        if single.keys() >= set(text):
            return self._listed(text)
        for at, character in enumerate(text):
            if character not in single:
                if at > first:
                    out.append(self._listed(text[first:at]))
                out.append(self._unlisted(character))
                first = at + 1
        if first < len(text):
            out.append(self._listed(text[first:]))
        return b"".join(out)

    def _line(self, line: str) -> bytes:
        if not self.by_parts:
            return self._whole(line)
        if BLANK * 2 in line:
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(line)))
        head, *rest = line.split(BLANK)
        return (self.parts[head] if head else b"") + b"".join([self.parts[BLANK + part] for part in rest])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        text = self.library.normalize(text)
        if self.line_end is None:
            return self._line(text)
        return self.line_end.join(map(self._line, text.split("\n")))

    # -- decoding -----------------------------------------------------------
    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library's decode: one blank is taken off in front where the
        model adds one; bytes that make no character become U+FFFD each."""
        raw, numbers = self.raw, ids.tolist()
        if numbers and not 0 <= min(numbers) <= max(numbers) < len(raw):
            raise ValueError("an id lies outside the model's pieces")
        parts = list(map(raw.__getitem__, numbers))
        if self.prefix_blank:
            at = next((i for i, part in enumerate(parts) if part), None)
            if at is not None and numbers[at] in self.plain and parts[at][:1] == b" ":
                parts[at] = parts[at][1:]
        if self.control.isdisjoint(numbers):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        # Bytes make a character only where they stand together.
        return "".join(_characters(b"".join(run)) if is_byte else b"".join(run).decode()
                       for is_byte, run in _runs(parts, [n in self.byte_ids for n in numbers]))


def _runs(parts: list[bytes], is_byte: list[bool]) -> Iterator[tuple[bool, list[bytes]]]:
    first = 0
    for at in range(1, len(parts) + 1):
        if at == len(parts) or is_byte[at] != is_byte[first]:
            yield is_byte[first], parts[first:at]
            first = at


def _characters(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at:at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


@functools.lru_cache(maxsize=2)
def pieces(model: str) -> Pieces:
    """One table per worker and model file."""
    return Pieces(model)


def _slices(batch: pa.RecordBatch, texts: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ROWS rows and about CHARS bytes of `texts`."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch[texts]), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes, dtype=np.int64), 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = min(first + ROWS, batch.num_rows, max(first + 1, int(np.searchsorted(ends, before + CHARS, side="right"))))
        yield batch.slice(first, last - first)
        first = last


def _id_lists(packed: list[bytes | None]) -> pa.Array:
    """Packed ids as an array column; a null stays null."""
    flat = np.frombuffer(b"".join(p or b"" for p in packed), "<i4")
    ends = np.cumsum([0, *(len(p or b"") >> 2 for p in packed)]).astype("<i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array([p is None for p in packed]))


def piece_encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids) of every whole text, without begin and end ids; with `decoded` also
    the text that the ids stand for, from the same task.

    One row per input row, so null and repeated ids stay; a null text counts as empty and has
    no ids; an empty table gives an empty result. Covered are models of the merge type, with
    byte pieces or without.
    """
    src = only(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text"):
                held = pieces(model)
                packed = [held.encode(t) for t in part["text"].to_pylist()]
                columns = [part["id"], pa.array([len(p) >> 2 for p in packed], pa.int64()), _id_lists(packed)]
                if decoded:
                    columns.append(pa.array([held.decode(np.frombuffer(p, "<i4")) for p in packed], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids", "decoded"][:len(columns)])

    schema = f"id {src.schema['id'].dataType.simpleString()}, n_tokens long, ids array<int>" + (", decoded string" if decoded else "")
    return map_batches(src, task, schema).withColumnRenamed("id", id_col)


def piece_decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """`encoded` with `decoded` (text) appended; a column of that name is replaced. Null ids
    decode to null, no ids to an empty text; an id that the model lacks is an error."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                out = [None if ids is None else pieces(model).decode(np.array(ids, "<i4")) for ids in part[ids_col].to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part[c] for c in kept], pa.array(out, pa.string())], [*kept, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name in kept)
    return map_batches(only(encoded, *kept), task, schema + ", decoded string")


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = piece_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


QUERIES = {"op13_pieces": (op13_pieces, None)}
