"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The model at hand is a byte-pair one: its segmentation is not the one of the greatest sum of scores, but the one in which
every two neighbours are compatible, that is, in which merging their joint text by score gives just these two pieces
back. Each prefix of a text has exactly one last piece that is compatible with the last piece of the prefix before it.
The search therefore keeps one backpointer for each position, as Viterbi's does, and only the rule by which a piece
survives is that of the model. Pieces are bounded, so positions further back than the longest piece cannot be extended;
when the paths of all that still can be meet in one boundary, the ids up to it are final and leave the window.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathproof.llm.common import map_arrow, text_key

#: Fixed by the library: the sign that stands for a blank.
SPACE = "▁"
#: Words and pairs that a worker remembers.
CACHED = 1_000_000
#: Longer runs without a blank are not remembered as one word.
LONG_WORD = 64
#: Positions after which the search looks for a common boundary.
STEP = 256
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceModel:
    """Vocabulary of a byte-pair model with byte fallback, a blank before the text, and no other normalisation."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.vocab_size()
        special = {i for i in range(size) if self.library.is_control(i) or self.library.is_unknown(i)}
        self.bytes = {int(self.library.id_to_piece(i)[3:-1], 16): i for i in range(size) if self.library.is_byte(i)}
        others = special | set(self.bytes.values())
        self.ids = {self.library.id_to_piece(i): i for i in range(size) if i not in others}
        self.score = {i: self.library.get_score(i) for i in self.ids.values()}
        self.text = [self.library.id_to_piece(i) for i in range(size)]
        self.longest = max(map(len, self.ids))
        # what an id alone stands for: the bytes of ASCII are text by themselves, others are not
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.plain = np.array([t if i in self.score else "" for i, t in enumerate(self.text)], dtype=object)
        self.beyond_ascii = np.zeros(size, dtype=bool)
        for b, i in self.bytes.items():
            if b < 0x80:
                self.plain[i] = chr(b)
            else:
                self.beyond_ascii[i] = True
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or len(self.bytes) != 256:
            raise ValueError("pieces with a blank after other signs, or without byte fallback, are not supported")
        # gives all pieces that end at each sign, the longest first
        self.lattice = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.lattice.add_word(p, (len(p), i))
        self.lattice.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        # no path crosses a boundary between two signs that no piece holds side by side
        self.inside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}

    def merged(self, text: str) -> list[str]:
        """The text merged by score, the leftmost first; only for the joint text of two pieces."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.score[found] > best):
                    best, at = self.score[found], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get(left << 32 | right)
        if known is None:
            a, b = self.text[left], self.text[right]
            known = self.merged(a + b) == [a, b]
            if len(self.pairs) < CACHED:
                self.pairs[left << 32 | right] = known
        return known

    def fallback(self, sign: str) -> list[int]:
        return [self.bytes[b] for b in sign.encode()]


class Search:
    """Streams one text: ``feed`` any parts of it, then ``finish``; both give the ids that are final."""

    _START, _BYTES = -1, -2

    def __init__(self, model: PieceModel):
        self.model = model
        self.window = ""  # signs since the last final boundary
        self.last = [self._START]  # for each position, the id that ends there; _BYTES stands for a sign's bytes
        self.sizes = [0]

    def feed(self, part: str) -> list[int]:
        out: list[int] = []
        for at in range(0, len(part), STEP):
            self._extend(part[at : at + STEP])
            out += self._commit()
        return out

    def _extend(self, part: str) -> None:
        model, last, sizes = self.model, self.last, self.sizes
        pairs, compatible = model.pairs, model.compatible
        done = len(self.window)
        # pieces that end in the new part start within the longest piece before it
        skipped = max(0, done - model.longest + 1)
        self.window += part
        for end, (size, piece) in model.lattice.iter(self.window[skipped:]):
            end += skipped + 1
            if end <= done or size > end:
                continue
            while done < end - 1:  # signs that are no piece
                done += 1
                last.append(self._BYTES)
                sizes.append(1)
            before = last[end - size]
            if before < 0 or (known if (known := pairs.get(before << 32 | piece)) is not None else compatible(before, piece)):
                last.append(piece)
                sizes.append(size)
                done = end
        for _ in range(len(self.window) - done):
            last.append(self._BYTES)
            sizes.append(1)

    def _common_boundary(self) -> int:
        """The last position that the paths of all positions which a later piece may follow have in common."""
        end = len(self.window)
        live = set(range(max(0, end - self.model.longest + 1), end + 1))
        while len(live) > 1:
            furthest = max(live)
            live.remove(furthest)
            live.add(furthest - self.sizes[furthest])
        return live.pop()

    def _path(self, end: int) -> list[int]:
        back: list[list[int]] = []
        while end > 0:
            piece = self.last[end]
            back.append(self.model.fallback(self.window[end - 1]) if piece == self._BYTES else [piece])
            end -= self.sizes[end]
        return [i for part in reversed(back) for i in part]

    def _commit(self) -> list[int]:
        cut = self._common_boundary()
        out = self._path(cut)
        # the boundary's own last piece stays, as the next one must be compatible with it
        self.window, self.last, self.sizes = self.window[cut:], self.last[cut:], [0, *self.sizes[cut + 1 :]]
        return out

    def finish(self) -> list[int]:
        out = self._path(len(self.window))
        self.window, self.last, self.sizes = "", [self._START], [0]
        return out


class Codec:
    """Texts to ids and back. Blanks end every path, so a word's ids are remembered whatever stands around it."""

    def __init__(self, path: str):
        self.model = PieceModel(path)

    def _word(self, word: str) -> bytes:
        inside, known = self.model.inside, self.model.words
        cuts = [k for k in range(1, len(word)) if word[k - 1 : k + 1] not in inside]
        if cuts and len(word) <= LONG_WORD:
            parts = [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)], strict=True)]
            out = b"".join([known.get(p) or self._search(p) for p in parts])
        else:
            return self._search(word)
        if len(known) < CACHED:
            known[word] = out
        return out

    def _search(self, word: str) -> bytes:
        search = Search(self.model)
        ids = search.feed(word[:-STEP])
        search._extend(word[-STEP:])  # what finish() gives need not be committed before
        out = np.array(ids + search.finish(), dtype="<i4").tobytes()
        if len(word) <= LONG_WORD and len(self.model.words) < CACHED:
            self.model.words[word] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype="<i4")
        known, word = self.model.words, self._word
        chunks = _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return np.frombuffer(b"".join([known.get(c) or word(c) for c in chunks]), dtype="<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Bytes that are no valid text become U+FFFD, one for each; control ids and unknown ids give nothing."""
        ids = np.asarray(ids, dtype=np.int64)
        if not self.model.beyond_ascii[ids].any():
            whole = "".join(self.model.plain[ids].tolist())
        else:
            whole = self._decode_bytes(ids.tolist())
        whole = whole.replace(SPACE, " ")
        return whole[1:] if whole.startswith(" ") else whole

    def _decode_bytes(self, ids: list[int]) -> str:
        """Bytes are put together before they are read as text."""
        out: list[str] = []
        pending = bytearray()
        byte_of, plain = self.model.byte_of, self.model.plain

        def flush() -> None:
            out.append(_lenient(bytes(pending)))
            pending.clear()

        for i in ids:
            if i in byte_of:
                pending.append(byte_of[i])
                continue
            if pending:
                flush()
            out.append(plain[i])
        if pending:
            flush()
        return "".join(out)


def _lenient(octets: bytes) -> str:
    out = []
    while octets:
        try:
            return "".join(out) + octets.decode()
        except UnicodeDecodeError as error:
            out.append(octets[: error.start].decode() + "�")
            octets = octets[error.start + 1 :]
    return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker."""
    return Codec(path)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, text_key, ids, ids_crc32) of every row of ``docs`` (doc_id, text); a null or empty text has no ids.

    The crc is that of the ids as little-endian 32-bit numbers. Null ids and repeated rows are encoded like others;
    further columns are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [codec(model).encode(t or "") for t in batch.column(2).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, "<i4"), *found]).astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends), flat)
            crc = pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), ids, crc], names=["doc_id", "text_key", "ids", "ids_crc32"]
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), "text")
    return map_arrow(slim, work, "doc_id long, text_key string, ids array<int>, ids_crc32 long")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the column decoded in place of ids; null ids give null."""
    kept = [c for c in encoded.columns if c != "ids"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            flat = column.flatten().to_numpy(zero_copy_only=False)  # the ids of null lists are left out
            ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            known = column.is_valid().to_pylist()
            parts = np.split(flat, ends[:-1]) if len(known) else []
            texts = [codec(model).decode(x) if valid else None for x, valid in zip(parts, known, strict=True)]
            yield pa.record_batch(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(texts, pa.string())],
                names=[*kept, "decoded"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != "ids")
    return map_arrow(encoded, work, f"{schema}, decoded string")


def op9_pieces(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip): whether decoding the ids gave the text back."""
    encoded = encode(docs.select("doc_id", "text"), model).withColumn("n_tokens", F.size("ids").cast("long"))
    back = text_key(F.col("decoded")) == F.col("text_key")
    return decode(encoded, model).select("doc_id", "n_tokens", "ids_crc32", back.alias("round_trip"))
