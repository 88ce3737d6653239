"""SentencePiece BPE encoding and decoding in vectorised merge rounds."""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import whole_text

#: Words that a task remembers; beyond it the memory starts anew.
MEMORY_WORDS = 400_000
#: Characters of texts whose new words are merged together.
ROUND_CHARS = 4_000_000
#: Rank of a pair that no piece joins.
NO_PIECE = np.iinfo(np.int32).max
SPACE = "▁"
#: Piece types of the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("one-each", _one_each)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) pairs of a message in the file's wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            value: int | bytes = number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


class PieceBpe:
    """Encoder and decoder for a BPE model with byte fallback and unnormalised text.

    ``encode_words`` holds the symbols of all words of a batch in one flat array. A round finds the
    least rank among each word's pairs, merges its occurrences from the left at once, and compacts
    the array; words in which no pair is left go. A pair's rank is that of the piece its text makes,
    whatever the two sides; pieces of one score share a rank. Where a piece can at once go on to one
    of at least its own score, only the leftmost occurrence is merged in a round, so the order is
    that of merging one by one.

    Words are cut where two neighbouring characters stand so in no piece: nothing merges across.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            content = list(_fields(file.read()))
        described = [dict(_fields(value)) for number, value in content if number == 1]
        trainer, normalizer = (dict(_fields(b"".join(v for n, v in content if n == part))) for part in (2, 3))
        plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or not plain:
            raise ValueError(f"{path}: not a BPE model with byte fallback, a space before the text and no normalisation")
        self.piece = [p.get(1, b"").decode("utf-8") for p in described]
        self.kind = np.array([p.get(3, NORMAL) for p in described])
        if np.isin(self.kind, (USER_DEFINED, UNUSED)).any() or (self.kind == BYTE).sum() != 256:
            raise ValueError(f"{path}: pieces of a kind that is not known here")
        scores = np.array([struct.unpack("<f", p.get(2, bytes(4)))[0] for p in described])
        self.byte_id = np.zeros(256, np.int32)
        for i in np.flatnonzero(self.kind == BYTE):
            self.byte_id[int(self.piece[i][3:5], 16)] = i
        normal = np.flatnonzero(self.kind == NORMAL).tolist()
        number = {self.piece[i]: i for i in normal}

        characters = np.array(sorted((ord(t), i) for t, i in number.items() if len(t) == 1))
        self.character, self.character_id = characters[:, 0], characters[:, 1].astype(np.int32)
        together = {ord(a) << 21 | ord(b) for t in number for a, b in zip(t, t[1:], strict=False)}
        self.together = np.array(sorted(together))

        order = {score: rank for rank, score in enumerate(sorted({-scores[i] for i in normal}))}
        rank = {i: order[-scores[i]] for i in normal}
        pairs: dict[int, int] = {}
        hasty: set[int] = set()
        for text, i in number.items():
            for cut in range(1, len(text)):
                left, right = number.get(text[:cut]), number.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
                hasty.update(part for part in (left, right) if part is not None and rank[i] <= rank[part])
        self.pair = np.array(sorted(pairs))
        self.joined = np.array([pairs[p] for p in self.pair.tolist()], np.int32)
        self.rank = np.array([rank[i] for i in self.joined.tolist()], np.int32)
        self.hasty = np.zeros(len(self.piece), bool)
        self.hasty[list(hasty)] = True

        if any(SPACE in t.lstrip(SPACE) for t in number):
            self.words = re.compile(r"[\s\S]+")
        else:
            self.words = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
            blanks = {len(t): rank[i] for t, i in number.items() if t == SPACE * len(t) and len(t) > 1}
            widest, shared = max(blanks, default=1), set(blanks.values())
            # if spaces are merged last, in one rank, a run of them is merged block by block from the left;
            # a block ends where it is the widest piece, so a run may be cut there
            last = shared == {max(rank.values())} and not any(rank[i] in shared for t, i in number.items() if t.strip(SPACE))
            if widest > 1 and last and len(self.encode_words([SPACE * widest])[0]) == 1:
                self.words = re.compile(rf"{SPACE}{{{widest}}}(?={SPACE})|{self.words.pattern}")

        self.bytes = [t.replace(SPACE, " ").encode("utf-8") for t in self.piece]
        for i in np.flatnonzero(self.kind == BYTE).tolist():
            self.bytes[i] = bytes([int(self.piece[i][3:5], 16)])
        for i in np.flatnonzero(self.kind == CONTROL).tolist():
            self.bytes[i] = b""
        for i in np.flatnonzero(self.kind == UNKNOWN).tolist():
            self.bytes[i] = trainer.get(44, " ⁇ ".encode())
        self.memory: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The words of a text, each with the spaces before it."""
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair of neighbours; a negative side is no piece."""
        wanted = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair, wanted), len(self.pair) - 1)
        known = (self.pair[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(known, self.rank[at], NO_PIECE).astype(np.int32), np.where(known, self.joined[at], -1).astype(np.int32)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        ids, ends = self._merged(words)
        return np.split(ids, ends[:-1]) if words else []

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and where each word's ids end: rounds of merges over all words."""
        if not words:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        characters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        size = len(characters)
        ends = np.cumsum([len(w) for w in words])
        at = np.minimum(np.searchsorted(self.character, characters), len(self.character) - 1)
        symbol = np.where(self.character[at] == characters, self.character_id[at], -1).astype(np.int32)

        # where a stretch starts: at a word, or between characters that are neighbours in no piece
        starts = np.zeros(size + 1, bool)
        starts[0] = True
        starts[ends] = True
        beside = characters[:-1] << 21 | characters[1:]
        found = np.minimum(np.searchsorted(self.together, beside), len(self.together) - 1)
        starts[1:-1] |= self.together[found] != beside
        settled = np.full(size, -2, np.int32)  # the piece that starts at a place; -2: none does
        place, opens = np.arange(size), starts[:size].copy()
        rank, joined = np.full(size, NO_PIECE, np.int32), np.full(size, -1, np.int32)
        inside = np.flatnonzero(~starts[1:size]) if size > 1 else np.zeros(0, np.int64)
        rank[inside], joined[inside] = self._ranked(symbol[inside], symbol[inside + 1])
        while True:
            first = np.flatnonzero(opens)
            least = np.minimum.reduceat(rank, first)
            stretch = np.cumsum(opens) - 1
            active = least[stretch] < NO_PIECE
            done = ~active
            settled[place[done]] = symbol[done]
            if not active.any():
                break
            symbol, place, opens, rank, joined, stretch = (x[active] for x in (symbol, place, opens, rank, joined, stretch))
            hits = np.flatnonzero(rank == least[stretch])
            # from the left, every other one of those that overlap
            fresh = np.r_[True, (hits[1:] != hits[:-1] + 1) | opens[hits[1:]]]
            order = np.arange(len(hits))
            hits = hits[(order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0]
            leads = np.r_[True, stretch[hits[1:]] != stretch[hits[:-1]]]
            hurried = np.maximum.accumulate(np.where(leads, np.arange(len(hits)), 0))
            hits = hits[leads | ~self.hasty[joined[hits[hurried]]]]

            symbol[hits] = joined[hits]
            stays = np.ones(len(symbol), bool)
            stays[hits + 1] = False
            moved = np.cumsum(stays) - 1
            merged = moved[hits]
            symbol, place, opens, rank, joined = (x[stays] for x in (symbol, place, opens, rank, joined))
            # the pairs on both sides of a merged symbol are new
            touched = np.zeros(len(symbol), bool)
            touched[merged] = True
            touched[merged[~opens[merged]] - 1] = True
            changed = np.flatnonzero(touched)
            follows = changed + 1 < len(symbol)
            follows[follows] = ~opens[changed[follows] + 1]
            rank[changed], joined[changed] = NO_PIECE, -1
            changed = changed[follows]
            rank[changed], joined[changed] = self._ranked(symbol[changed], symbol[changed + 1])
        return self._ids(characters, settled, ends)

    def _ids(self, characters: np.ndarray, settled: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The settled pieces, and where each word's end; a character that is no piece gives its bytes."""
        unknown = settled == -1
        wide = np.where(settled == -2, 0, 1)
        missing = characters[unknown]
        wide[unknown] = 1 + (missing > 0x7F) + (missing > 0x7FF) + (missing > 0xFFFF)
        ids = np.repeat(settled, wide)
        if len(missing):
            raw = "".join(map(chr, missing.tolist())).encode("utf-8", "surrogatepass")
            ids[ids == -1] = self.byte_id[np.frombuffer(raw, np.uint8)]
        return ids.astype("<u4"), np.cumsum(wide)[ends - 1]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        waiting: list[list[str]] = []
        held = 0
        for text in texts:
            waiting.append(self.split(text))
            held += len(text)
            if held >= ROUND_CHARS:
                yield from self._encode_split(waiting)
                waiting, held = [], 0
        yield from self._encode_split(waiting)

    def _encode_split(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        if len(self.memory) > MEMORY_WORDS:
            self.memory = {}
        memory = self.memory
        new = list({word for words in texts for word in words if word not in memory})
        ids, ends = self._merged(new)
        raw, at = ids.tobytes(), 0
        for word, end in zip(new, (4 * ends).tolist(), strict=True):
            memory[word] = raw[at:end]
            at = end
        for words in texts:
            yield np.frombuffer(b"".join(map(memory.__getitem__, words)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; the space before the first piece goes, broken byte sequences become U+FFFD each."""
        numbers = ids.tolist()
        raw = b"".join(map(self.bytes.__getitem__, numbers))
        first = next((i for i in numbers if self.kind[i] != CONTROL), None)
        if first is not None and self.kind[first] == NORMAL and self.piece[first].startswith(SPACE):
            raw = raw[1:]
        return raw.decode("utf-8", "one-each")


def _chosen(rows: DataFrame, id_col: str, column) -> tuple[DataFrame, str]:
    chosen = rows.select(F.col(id_col).alias("_id"), column)
    return chosen, chosen.schema["_id"].dataType.simpleString()


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` per row: the ids of the whole text, in order, as an array of ints.

    Null and empty texts give an empty array. Rows with a null id and repeated rows are encoded like
    any other, an empty table gives an empty one, extra columns are ignored whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PieceBpe(model)
        for batch in batches:
            row, lists, held = 0, [], 0
            for found in bpe.encode(t.as_py() for t in batch.column("_text")):
                lists.append(found.astype(np.int32))
                held += len(found)
                if held > 1 << 20:
                    yield _id_lists(batch.column("_id").slice(row, len(lists)), lists)
                    row, lists, held = row + len(lists), [], 0
            if lists:
                yield _id_lists(batch.column("_id").slice(row, len(lists)), lists)

    chosen, kind = _chosen(docs, id_col, whole_text(F.col(text_col)).alias("_text"))
    return chosen.mapInArrow(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)


def _id_lists(id_column: pa.Array, lists: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32)
    values = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))
    return pa.RecordBatch.from_arrays([id_column, values], names=["_id", "ids"])


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` per row; a null or empty list gives an empty text, an unknown id raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PieceBpe(model)
        for batch in batches:
            texts = [bpe.decode(np.asarray(x.values)) if x.is_valid else "" for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=["_id", "text"])

    chosen, kind = _chosen(encoded, id_col, F.col(ids_col).cast("array<int>").alias("ids"))
    return chosen.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)


def piece_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encoded and decoded again in one pass, digests only.

    The first digest is of the ids in decimal, joined by commas, the second of the decoded text in
    UTF-8. Null and empty texts have no ids and the digests of nothing. Null ids, repeated rows, empty
    tables and extra columns are treated as by ``encode_documents``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PieceBpe(model)
        decimal = list(map(str, range(len(bpe.piece))))
        for batch in batches:
            count, of_ids, of_text = [], [], []
            for ids in bpe.encode(t.as_py() for t in batch.column("_text")):
                count.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    chosen, kind = _chosen(docs, id_col, whole_text(F.col(text_col)).alias("_text"))
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return chosen.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
