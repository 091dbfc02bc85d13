"""Pieces of a public SentencePiece model with the bytes of the source text that each stands for, and back to text."""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tandem.llm.common import packed, text_of, unpacked

MARK = "▁"
_MARK, _LOST = MARK.encode(), "�".encode()
#: Words a Python worker remembers before it starts afresh, and the longest that is remembered.
REMEMBERED, LONGEST = 400_000, 48
#: Bytes of text that are encoded, and given back, together; a text is never cut.
GROUP = 1 << 20


class CharacterMap:
    """A model's compiled rules: a double array over the bytes of what is replaced, and the replacements.

    A unit holds its label in the low byte, where its children start in the bits from 10 up, and whether a rule ends
    here; that rule's place among the replacements is in the child with label 0.
    """

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little")
        self.units: list[int] = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.replacements = compiled[4 + size :]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes replaced) of the longest rule that fits at a place."""
        units = self.units
        if not units:
            return None
        found, node = None, self._children(units[0])
        for k in range(at, len(data)):
            byte = data[k]
            if not byte or (node ^ byte) >= len(units):
                break
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._children(unit)
            if unit >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, k + 1 - at)
        if found is None:
            return None
        place, length = found
        return self.replacements[place : self.replacements.index(0, place)], length


def character(data: bytes, at: int) -> tuple[bytes, int]:
    """The character at a place; a byte that begins none counts as U+FFFD."""
    lead = data[at]
    size = 1 if lead < 0x80 else 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 0
    try:
        data[at : at + size].decode()
    except UnicodeDecodeError:
        size = 0
    return (data[at : at + size], size) if size else (_LOST, 1)


class Normaliser:
    """What a model does to a text before it is cut, and where each byte of the outcome comes from."""

    def __init__(self, compiled: bytes, prefix: bool, suffix: bool, squeeze: bool, escape: bool, symbols: list[bytes] = ()) -> None:
        self.map, self.prefix, self.suffix, self.squeeze = CharacterMap(compiled), prefix, suffix, squeeze
        self.space = _MARK if escape else b" "
        self.symbols = re.compile(b"|".join(map(re.escape, sorted(symbols, key=len, reverse=True)))) if symbols else None
        self.plain = not compiled and not squeeze and not symbols

    def step(self, data: bytes, at: int) -> tuple[bytes, int]:
        """(outcome, bytes used) at a place: a symbol as it is, else the longest rule, else a character as it is."""
        if self.symbols and (whole := self.symbols.match(data, at)):
            return whole.group(), len(whole.group())
        return self.map.longest(data, at) or character(data, at)

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """(outcome, source): ``source[k]`` is where that begins in ``data`` which byte k of the outcome comes from;
        one more entry gives the end."""
        if self.plain:
            try:
                data.decode()
            except UnicodeDecodeError:
                pass
            else:
                return self.unmapped(data)
        out, source, at, end = bytearray(), [], 0, len(data)

        def put(piece: bytes) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        while self.squeeze and at < end:
            piece, used = self.step(data, at)
            if piece != b" ":
                break
            at += used
        if at == end:
            return b"", np.zeros(1, np.int32)
        if self.prefix and not self.suffix:
            put(self.space)
        after_space = self.squeeze
        while at < end:
            piece, used = self.step(data, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", self.space))
                after_space = self.squeeze and piece.endswith(b" ")
            at += used
        while self.squeeze and out.endswith(self.space):
            at = source[len(out) - len(self.space)]
            del out[-len(self.space) :], source[-len(self.space) :]
        if self.prefix and self.suffix:
            put(self.space)
        return bytes(out), np.array([*source, at], np.int32)

    def unmapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The same without any rule, for the whole text at once."""
        if not data:
            return b"", np.zeros(1, np.int32)
        raw = np.frombuffer(data, np.uint8)
        begin = np.arange(len(raw), dtype=np.int32)
        begin[raw & 0xC0 == 0x80] = 0
        np.maximum.accumulate(begin, out=begin)
        wide = len(self.space)
        source = np.repeat(begin, np.where(raw == 32, wide, 1)) if wide > 1 else begin
        before, after = (0, wide) if self.suffix else (wide, 0)
        edges = [np.zeros(before * self.prefix, np.int32), source, np.full(after * self.prefix + 1, len(raw), np.int32)]
        text = data.replace(b" ", self.space)
        return self.space * (before > 0 and self.prefix) + text + self.space * (after > 0 and self.prefix), np.concatenate(edges)


class Codec(dict):
    """A model's cutting and joining. Words recur, so each distinct word is cut once per worker."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as layout

        model = layout.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        spec, trained = model.normalizer_spec, model.trainer_spec
        symbols = [p.piece.encode() for p in model.pieces if p.type == layout.ModelProto.SentencePiece.USER_DEFINED]
        self.normalise = Normaliser(
            spec.precompiled_charsmap, spec.add_dummy_prefix, trained.treat_whitespace_as_suffix, spec.remove_extra_whitespaces, spec.escape_whitespaces, symbols
        )
        # Texts come to the cutter normalised: it must leave them as they are.
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        byte, unknown = layout.ModelProto.SentencePiece.BYTE, layout.ModelProto.SentencePiece.UNKNOWN
        self.fixed = trained.byte_fallback and any(p.type == byte for p in model.pieces)
        self.widths = np.array([1 if p.type == byte else 0 if p.type == unknown else len(p.piece.encode()) for p in model.pieces], np.int64)
        # No piece holds a mark behind anything else: then no merge crosses the place before a word's marks.
        inside = re.compile(f"[^{MARK}]{MARK}")
        self.by_word = self.fixed and trained.model_type == layout.TrainerSpec.BPE and not symbols and not any(inside.search(p.piece) for p in model.pieces)
        self.word = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def cut(self, texts: list[str]) -> list[bytes]:
        """Ids of normalised texts as little-endian 32-bit integers."""
        return [array("i", ids).tobytes() for ids in self.cutter.encode(texts, num_threads=1)]

    def cut_words(self, texts: list[str]) -> list[bytes]:
        listed = [self.word.findall(text) for text in texts]
        if len(self) > REMEMBERED:
            self.clear()
        new = list(set(chain.from_iterable(listed)).difference(self))
        self.update(zip(new, self.cut(new)))
        out = [b"".join(map(self.__getitem__, words)) for words in listed]
        for word in new:
            if len(word) > LONGEST:
                del self[word]
        return out

    def project(self, ids: np.ndarray, edges: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = source[edges]
        return ids, at[:-1], at[1:]

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, begins, ends) of each text's UTF-8: the pieces, and the source bytes from begin up to end of each.

        A character that falls back to bytes belongs to the last of its pieces; those before it are empty there.
        """
        normal = [self.normalise(data) for data in texts]
        plain = [outcome.decode() for outcome, _ in normal]
        if not self.fixed:  # an unknown piece may be of any length, which only the cutter knows
            found = [self.cutter.encode(text.encode(), return_type="proto", num_threads=1).pieces for text in plain]
            return [self.project(np.array([p.id for p in f], np.int32), np.array([0, *[p.end for p in f]]), source) for f, (_, source) in zip(found, normal)]
        cut = self.cut_words(plain) if self.by_word else self.cut(plain)
        out = []
        for data, (_, source) in zip(cut, normal):
            ids = np.frombuffer(data, "<i4")
            edges = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(self.widths[ids], out=edges[1:])
            out.append(self.project(ids, edges, source))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.whole.decode([x.tolist() for x in ids], num_threads=1) if ids else []


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_texts(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Input columns (those in ``carry``, if given), ``ids``, ``begins``, ``ends`` and ``decoded``.

    Ids are those of the model's own encoding, without begin, end or sampling. Piece k stands for the bytes of the
    text's UTF-8 from ``begins[k]`` up to ``ends[k]``; pieces follow each other without a gap, except where the model
    drops white space. A piece that the model adds is empty there. ``decoded`` is what the model's decoder makes of all ids.

    Each text is normalised whole, by the longest rule of the model's character map at every place, with the source of
    each byte noted; the pieces of the outcome are then led back through these notes. A null or empty text has no
    pieces and decodes to the empty text; bytes that are no UTF-8 count as U+FFFD each. Equal texts, and repeated rows,
    have equal results. An empty table gives no rows. Input columns named like an output are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path)

        def flush(rows: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
            made = model.encode(texts)
            edges = pa.array(np.concatenate([[0], np.cumsum([len(m[0]) for m in made])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate([m[k] for m in made]).astype(np.int32))) for k in range(3)]
            return pa.RecordBatch.from_arrays([rows, *lists, pa.array(model.decode([m[0] for m in made]), pa.string())], names)

        for batch in batches:
            rows, texts, first, held = batch.column("row"), [], 0, 0
            for k, value in enumerate(batch.column("text")):
                texts.append(value.as_buffer().to_pybytes())
                held += len(texts[-1])
                if held >= GROUP or k + 1 == batch.num_rows:
                    yield flush(rows.slice(first, len(texts)), texts)
                    texts, first, held = [], k + 1, 0

    names = ["row", "ids", "begins", "ends", "decoded"]
    whole = packed(docs, carry, text=text_of(text))
    lists = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in names[1:4]]
    schema = T.StructType([whole.schema["row"], *lists, T.StructField("decoded", T.StringType())])
    return unpacked(whole.mapInArrow(run, schema), *names[1:])
