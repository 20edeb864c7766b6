"""Token counts with a public tokenizer, over whole texts of any length.

Two exact ways to cut an encoding:

* `PieceEncoder` cuts a text before any ASCII white space that follows a character which surely is none, and before
  a mark that follows a letter. The two tokenizers' patterns end a word at both, look ahead only over white space,
  and normalise nothing across such a cut; so the pieces' ids, joined, are the text's ids. Each distinct piece is
  encoded once and kept.
* `encode_huge` is overlap resynchronisation for documents too long to encode at once: overlapping chunks are
  encoded with offsets and spliced where both chunks begin a word at the same character. The pattern looks
  behind nowhere, so from a common word start on, both scans stay equal; before it, the left chunk's words are
  right as long as they end `GUARD` characters before its end. Where an overlap has no common start it is widened.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import small_batches

#: Characters at a chunk's end whose words a cut may have changed; longer than any look-ahead and any special token.
GUARD = 64
#: A document longer than this (in bytes of UTF-8) goes by overlapping chunks.
HUGE = 32_768
CHUNK, OVERLAP = 16_384, 256
#: Bytes of text whose distinct pieces are looked up at once.
ENCODE_BYTES = 4_000_000

_SPACE = ~K.SPACED
#: Lower-cases A-Z and makes a blank of each ASCII white space.
_PLAIN = np.where(_SPACE, 0x20, K.lowered(np.arange(256))).astype(np.uint8)
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: The second bytes of the two-byte letters U+00C0 to U+00FF, behind 0xC3: all but the signs for times and divided by.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: Marks before which both patterns end a word of letters: ASCII's, but for the apostrophe, which may open an ending.
_STOP = np.zeros(256, dtype=bool)
_STOP[np.frombuffer(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", dtype=np.uint8)] = True


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def piece_starts(data: np.ndarray, offsets: np.ndarray, stops: np.ndarray = _STOP) -> np.ndarray:
    """Where pieces start: at each document, at white space behind a visible character, at a stop behind a letter A-Z, a-z
    or one of U+00C0 to U+00FF.

    A visible character is ASCII 0x21-0x7E, or one of two UTF-8 bytes that starts with 0xC3-0xDF (no white space is).
    """
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 1:
        visible = _VISIBLE[data]
        visible[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
        cut[1:n] = visible[:-1] & _SPACE[data[1:]]
        letter = _LETTER[data]
        letter[1:] |= _LATIN[data[1:]] & (data[:-1] == 0xC3)
        cut[1:n] |= letter[:-1] & stops[data[1:]]
    cut[offsets] = True
    cut[n] = False
    return np.flatnonzero(cut)


class PieceEncoder:
    """Encodes text columns by distinct pieces; keeps up to `most` pieces between calls, those that came in most of them."""

    def __init__(self, path: str, most: int = 300_000):
        self.tokenizer, self.most = load_tokenizer(path), most
        self.mark_id, self.mark = next((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized))
        self.between = self.mark
        if not self.tokenizer.encode(" \n ", add_special_tokens=False).ids and len(ids := self.tokenizer.encode("\x01", add_special_tokens=False).ids) == 1:
            # white space is dropped, so a control character between blanks is a word and an id of its own
            self.mark_id, self.mark, self.between = ids[0], "\x01", " \x01 "
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.stops = _STOP.copy()
        for t in self.added:
            self.stops[np.frombuffer(t, dtype=np.uint8)] = False
        #: Capitals A-Z may be lowered before pieces are told apart where the library lowers them anyway.
        self.lowers = all(self.tokenizer.encode(x, add_special_tokens=False).ids == self.tokenizer.encode(x.lower(), add_special_tokens=False).ids for x in ("ABC", "Hello", "E\u0301T", "XYZ Q"))
        #: Any ASCII white space may be a blank where the library drops all of it and tells words apart by each alike.
        alike = {tuple(self.tokenizer.encode(f"a{c}b{c}{c}'{c}s{c}1{c}2,{c}.", add_special_tokens=False).ids) for c in " \t\n\x0b\x0c\r"}
        self.blanks = self.mark == "\x01" and len(alike) == 1
        #: Kept pieces, by number in how many calls each came, their ids' lengths and starts in flat; Arrow and numpy, for a
        #: million strings would weigh.
        self.known = pa.array([], pa.string())
        self.used = np.zeros(0, dtype=np.int32)
        self.lens = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def learn(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The number of each of these pieces, all different; by number: ids' lengths and starts; all ids."""
        at = pc.index_in(pieces, value_set=self.known)
        got = at.fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(got < 0)
        self.used[got[got >= 0]] += 1
        lens, starts, flat = self.lens, self.starts, self.flat
        if len(missing):
            new_pieces = pieces.take(pa.array(missing))
            new, new_lens = self.fresh(new_pieces.to_numpy(zero_copy_only=False).tolist())
            got[missing] = np.arange(len(lens), len(lens) + len(missing))
            starts = np.concatenate((starts, len(flat) + np.cumsum(new_lens) - new_lens))
            lens, flat = np.concatenate((lens, new_lens.astype(np.int32))), np.concatenate((flat, new))
            self.known = pa.concat_arrays([self.known, new_pieces])
            self.used = np.concatenate((self.used, np.zeros(len(missing), dtype=np.int32)))
            self.lens, self.starts, self.flat = lens, starts, flat
            if len(lens) > self.most:
                self.forget()
        return got, lens, starts, flat

    def forget(self) -> None:
        """Keep half of `most` pieces, those that came in most calls, of equals the newest; older calls count half."""
        n = len(self.used)
        keep = np.sort(n - 1 - np.argsort(-self.used[::-1], kind="stable")[: self.most // 2])
        self.known, self.used = self.known.take(pa.array(keep)), self.used[keep] // 2
        lens, starts = self.lens[keep], self.starts[keep]
        sums = np.cumsum(lens, dtype=np.int64) - lens
        self.flat = self.flat[np.repeat(starts - sums, lens) + np.arange(lens.sum())]
        self.lens, self.starts = lens, sums

    def fresh(self, pieces: list[str], group: int = 50) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these pieces and each one's number of them.

        Pieces go joined by a mark, so each is encoded alone at a fraction of the cost of a call: an added token, for
        which the library cuts a text before anything else it does, or, where white space is dropped, a control
        character between blanks. A piece that has the mark in it goes by itself.
        """
        alone = {k: self.tokenizer.encode(p, add_special_tokens=False).ids for k, p in enumerate(pieces) if self.mark in p}
        joined = [p if k not in alone else "" for k, p in enumerate(pieces)] if alone else pieces
        runs = self.tokenizer.encode_batch_fast([self.between.join(joined[k : k + group]) for k in range(0, len(joined), group)], add_special_tokens=False)
        ids = np.array([x for e in runs for x in (*e.ids, self.mark_id)], dtype=np.uint32)
        at = np.flatnonzero(ids == self.mark_id)
        lens = np.diff(at, prepend=-1) - 1
        flat = ids[ids != self.mark_id]
        if alone:
            parts = np.split(flat, np.cumsum(lens)[:-1])
            for k, own in alone.items():
                parts[k], lens[k] = np.array(own, dtype=np.uint32), len(own)
            flat = np.concatenate(parts)
        return flat, lens

    def encode(self, data: np.ndarray, offsets: np.ndarray, want_ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (none if not wanted), and each document's number of ids."""
        if self.lowers:
            low = _PLAIN[data] if self.blanks else K.lowered(data)
            raw = low.tobytes()
            if not any(t in raw for t in self.added):  # an added token is matched before letters are lowered
                data = low
        starts = piece_starts(data, offsets, self.stops)
        column = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.concatenate((starts, [len(data)])).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
        words = column.dictionary_encode()
        known, by_lens, by_starts, flat = self.learn(words.dictionary)
        codes = known[words.indices.to_numpy()] if len(starts) else np.zeros(0, dtype=np.int64)
        lens = by_lens[codes].astype(np.int64)
        sums = np.concatenate(([0], np.cumsum(lens)))
        counts = np.diff(sums[np.searchsorted(starts, offsets)])
        if not want_ids or not len(codes):
            return np.zeros(0, dtype=np.uint32), counts
        return flat[np.repeat(by_starts[codes] - sums[:-1], lens) + np.arange(sums[-1])], counts


_encoders: dict[str, PieceEncoder] = {}
K._kept["caches"].append(_encoders)


def encoder_of(path: str) -> PieceEncoder:
    """This process's encoder for a tokenizer; its pieces serve all tasks that the process gets."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _chunk(tokenizer, text: str, a: int, b: int) -> tuple[list[int], dict[int, int]]:
    """Ids of text[a:b]; where words start (in the whole text) and at which of the ids."""
    e = tokenizer.encode(text[a:b], add_special_tokens=False)
    starts: dict[int, int] = {}
    last = -1
    for k, (word, (at, _)) in enumerate(zip(e.word_ids, e.offsets, strict=True)):
        if word is None or word != last:
            starts.setdefault(a + at, k)
        last = -1 if word is None else word
    return e.ids, starts


def encode_huge(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Ids of a text, by overlapping chunks spliced at common word starts."""
    if len(text) <= chunk:
        return tokenizer.encode(text, add_special_tokens=False).ids
    out: list[int] = []
    end = chunk
    ids, starts = _chunk(tokenizer, text, 0, end)
    begin = 0  # of the ids at hand, those before are spliced away
    while end < len(text):
        back = overlap
        while True:
            a = max(0, end - back)
            b = min(len(text), a + max(chunk, 2 * back))
            right, right_starts = _chunk(tokenizer, text, a, b)
            common = [p for p in right_starts if a < p <= end - GUARD and starts.get(p, -1) >= begin]
            if common or b == len(text) and a == 0:
                break
            if back >= end:  # nothing in common back to the start: take the text from there as one chunk
                a = 0
                right, right_starts = _chunk(tokenizer, text, 0, b)
                common = []
                break
            back *= 2
        if common:
            p = max(common)
            out += ids[begin : starts[p]]
            begin = right_starts[p]
        else:  # the new chunk starts at the text's start, so it stands for all before
            out, begin = [], 0
        ids, starts, end = right, right_starts, b
    return out + ids[begin:]


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; other columns are left out.
    One pass without a shuffle: memory is one Arrow batch, one slice of it, and the kept pieces.
    """
    small_batches(docs.sparkSession)

    @K.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        for batch in K.gathered(batches, ENCODE_BYTES):
            data, offsets = K.utf8(batch.column(1))
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            huge = np.diff(offsets) > HUGE
            for i, j in K.slices(offsets, ENCODE_BYTES):
                sizes = np.diff(offsets[i : j + 1])
                if huge[i:j].any():
                    sizes = np.where(huge[i:j], 0, sizes)
                    part = np.concatenate([data[offsets[d] : offsets[d + 1]] for d in range(i, j) if not huge[d]] or [data[:0]])
                else:
                    part = data[offsets[i] : offsets[j]]
                counts[i:j] = encoder.encode(part, np.concatenate(([0], np.cumsum(sizes))), want_ids=False)[1]
            for d in np.flatnonzero(huge).tolist():
                counts[d] = len(encode_huge(encoder.tokenizer, data[offsets[d] : offsets[d + 1]].tobytes().decode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents; see token_counts for null and empty texts and repeated rows."""
    import public_tokenizers

    from .common import table

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
