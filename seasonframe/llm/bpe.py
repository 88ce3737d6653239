"""BPE encoding and decoding with an index from each pair of symbols to its positions."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers

from seasonframe.llm.common import whole_text
from seasonframe.llm.tokens import byte_alphabet

#: Words that a task remembers; beyond it the memory starts anew.
MEMORY_WORDS = 500_000
#: Characters whose new words are indexed together.
INDEX_CHARS = 4_000_000


_LATIN_LETTERS, _LATIN_NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
#: The split pattern for lower-cased Latin-1 text: the same words, and faster to find.
_LATIN_WORDS = re.compile(
    rf"[{_LATIN_LETTERS}]+|[{_LATIN_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0{_LATIN_LETTERS}{_LATIN_NUMBERS}]+"
)


class PairIndexBpe:
    """Encoder and decoder for a BPE file with word ends, lower case and white space dropped.

    ``encode_words`` merges all words of a batch at once: each pair of neighbouring symbols maps to
    all its positions in the batch, active pairs are taken in ascending rank, every position of a
    pair is merged, and the lists of the pairs this makes get the new positions. Words are
    independent, so taking the lowest rank of the batch is also each word's own order.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        steps = described["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"]:
            raise ValueError(f"{path}: not a lower-case BPE file with word ends")
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.merges: dict[int, tuple[int, int]] = {}  # left and right id in one number -> rank, merged id
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocab[left] << 32 | vocab[right]] = (rank, vocab[left + right])
        letters = byte_alphabet()
        self.inner = np.array([vocab[letters[b]] for b in range(256)])
        self.final = np.array([vocab[letters[b] + self.suffix] for b in range(256)])
        pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.newer, self.older_words = _for_newer_characters(pattern)
        self.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.memory: dict[str, bytes] = {}

    def _plain_words(self, text: str) -> list[str]:
        if _is_latin(text):
            return _LATIN_WORDS.findall(text.lower())
        if not self.newer.search(text):
            return self.words.findall(normalised(text))
        return self.older_words.findall(self.normalizer.normalize_str(text))

    def split(self, text: str) -> list[str]:
        """Words of the normalised text; special tokens stay whole."""
        if self.cut is None or "<|" not in text or not self.cut.search(text):
            return self._plain_words(text)
        found: list[str] = []
        at = 0
        for m in self.cut.finditer(text):
            found += self._plain_words(text[at : m.start()])
            found.append(m.group())
            at = m.end()
        return found + self._plain_words(text[at:])

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        raw = [word.encode("utf-8", "surrogatepass") for word in words]
        if not raw:
            return []
        ends = np.cumsum([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        symbols[ends - 1] = self.final[data[ends - 1]]
        # places of the next and the last symbol of the same word, -1 where there is none
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        after[ends - 1] = -1
        before[0] = -1
        before[ends[:-1]] = -1
        places: dict[int, list[np.ndarray]] = {}
        active: list[tuple[int, int]] = []
        first = np.flatnonzero(after >= 0)
        self._list(places, active, symbols[first], symbols[first + 1], first)
        while active:
            _, pair = heapq.heappop(active)
            left, right, merged = pair >> 32, pair & 0xFFFFFFFF, self.merges[pair][1]
            at = np.unique(np.concatenate(places.pop(pair)))
            at = at[(symbols[at] == left) & (after[at] >= 0)]
            at = at[symbols[after[at]] == right]  # the others were merged away since they were listed
            if left == right and len(at) > 1:
                at = _every_other(at, after)
            follower = after[at]
            symbols[at], symbols[follower] = merged, -1
            last = after[follower]
            after[at], after[follower] = last, -1
            inside = last >= 0
            before[last[inside]] = at[inside]
            earlier = before[at]
            preceded = earlier >= 0
            self._list(
                places,
                active,
                np.concatenate([symbols[at[inside]], symbols[earlier[preceded]]]),
                np.concatenate([symbols[last[inside]], symbols[at[preceded]]]),
                np.concatenate([at[inside], earlier[preceded]]),
            )
        alive = symbols >= 0
        return np.split(symbols[alive].astype("<u4"), np.cumsum(alive)[ends[:-1] - 1])

    def _list(self, places: dict[int, list[np.ndarray]], active: list, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> None:
        """Add places to the lists of their pairs; pairs that were not listed become active."""
        pairs = left.astype(np.int64) << 32 | right
        order = np.argsort(pairs, kind="stable")
        pairs, at = pairs[order], at[order]
        starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else []
        edges = [*starts, len(pairs)]
        for a, b, pair in zip(edges, edges[1:], pairs[starts].tolist() if len(pairs) else [], strict=False):
            if pair in self.merges:
                if pair in places:
                    places[pair].append(at[a:b])
                else:
                    places[pair] = [at[a:b]]
                    heapq.heappush(active, (self.merges[pair][0], pair))

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        waiting: list[list[str]] = []
        held = 0
        for text in texts:
            waiting.append(self.split(text))
            held += len(text)
            if held >= INDEX_CHARS:
                yield from self._encode_split(waiting)
                waiting, held = [], 0
        yield from self._encode_split(waiting)

    def _encode_split(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        if len(self.memory) > MEMORY_WORDS:
            self.memory = {}
        if not self.memory:
            self.memory = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        memory = self.memory
        new = list({word for words in texts for word in words if word not in memory})
        for word, ids in zip(new, self.encode_words(new), strict=True):
            memory[word] = ids.tobytes()
        for words in texts:
            yield np.frombuffer(b"".join(map(memory.__getitem__, words)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by spaces, special ones kept: the file names no decoder."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of places that follow each other, as of one symbol in a row, the first, third, and so on."""
    joined = np.r_[False, after[at[:-1]] == at[1:]]
    number = np.arange(len(at))
    run_start = np.maximum.accumulate(np.where(joined, 0, number))
    return at[(number - run_start) % 2 == 0]


def _for_newer_characters(pattern: str) -> tuple[regex.Pattern, regex.Pattern]:
    """A search for characters that Python's Unicode tables lack, and the pattern for texts with such.

    The word splitter's tables are the newest; which of its letters and numbers the tokenizers'
    tables lack is asked of them, and the pattern counts those as other characters.
    """
    assigned, wide = regex.compile(r"\P{Cn}"), regex.compile(r"[\p{L}\p{N}]")
    newer = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and assigned.match(c)]
    lacking = normalizers.Replace(Regex(r"[\p{L}\p{N}]"), "").normalize_str("".join(filter(wide.match, newer)))
    other = _listed(lacking)
    older = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|{other})")
    for kind in ("L", "N"):
        older = older.replace(rf"[\p{{{kind}}}]", rf"(?:(?!{other})\p{{{kind}}})")
    return regex.compile(_listed(newer)), regex.compile(older)


def _listed(characters: Iterable[str]) -> str:
    """A character class, by ranges; one that matches nothing when there is none."""
    ranges: list[list[int]] = []
    for c in map(ord, characters):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return f"[{''.join(f'\\U{a:08x}-\\U{b:08x}' for a, b in ranges)}]" if ranges else "(?!)"


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def normalised(text: str) -> str:
    """NFC, white space runs as one space, lower case by character (no rule for a final sigma)."""
    if text.isascii():
        return text.lower()
    composed = unicodedata.normalize("NFC", text)
    return composed.replace("Σ", "σ").lower()


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` per row: the ids of the whole text (null: empty), in order, as an array of ints.

    Each task builds its own pair index over the words that are new to it. Rows with a null id and
    repeated rows are encoded like any other, an empty table gives an empty one; extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PairIndexBpe(tokenizer)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("_text"))
            row, ids, held = 0, [], 0
            for found in bpe.encode(texts):
                ids.append(found.astype(np.int32))
                held += len(found)
                if held > 1 << 20:
                    yield _id_lists(batch.column("_id").slice(row, len(ids)), ids)
                    row, ids, held = row + len(ids), [], 0
            if ids:
                yield _id_lists(batch.column("_id").slice(row, len(ids)), ids)

    chosen = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    kind = chosen.schema["_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_col)


def _id_lists(id_column: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
    return pa.RecordBatch.from_arrays([id_column, lists], names=["_id", "ids"])


def decode_documents(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` per row; a null list gives an empty text, an unknown id raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PairIndexBpe(tokenizer)
        for batch in batches:
            texts = [bpe.decode(np.asarray(x.values)) if x.is_valid else "" for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=["_id", "text"])

    chosen = encoded.select(F.col(id_col).alias("_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = chosen.schema["_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"_id {kind}, text string").withColumnRenamed("_id", id_col)


def encoding_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encoded and decoded again in one pass, digests only.

    Null and empty texts have no ids and the digests of nothing; texts of any length are taken whole. Null
    ids and repeated rows stay rows, an empty table gives an empty one, extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PairIndexBpe(tokenizer)
        for batch in batches:
            count, of_ids, of_text = [], [], []
            for ids in bpe.encode(t.as_py() for t in batch.column("_text")):
                count.append(len(ids))
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    chosen = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    kind = chosen.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return chosen.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
