"""Language identification: text likelihoods fused with declared language, address and host priors."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, stored, whole_text

#: Labelled documents of each language that the text model is counted on: the lowest by hash.
SAMPLE_DOCS = 4000
#: Labelled documents of all languages together; with many languages each gets its share, one at least.
SAMPLE_TOTAL = 400_000
#: A language whose text likelihood is below the best one's by this factor's logarithm is impossible.
IMPOSSIBLE = 200.0
#: Statements and languages up to which their table is broadcast, each about 16 bytes.
BROADCAST_COUNTS = 500_000
#: Hash buckets of letter triples.
BUCKETS = 1 << 15
#: Languages whose likelihoods a task holds for every bucket, about 260 kB each.
COLUMNS = 64
#: Count that every bucket has in every language before any text.
SMOOTH = 0.2
#: Triples overlap, so each counts for less than an independent observation.
TEXT_WEIGHT = 0.4
#: Pseudo-counts with which a level of the address falls back on the one above it.
PRIOR_STRENGTH = 20.0
#: A document below this posterior, or without a letter, is rejected.
MIN_CONFIDENCE = 0.5
#: Languages that a country's address suffix speaks for (fixed values, ISO 3166 and ISO 639 codes).
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "nz": "en", "ie": "en"}

_CHUNK = 1 << 20


@dataclass
class TextModel:
    """Languages, and the log likelihoods of the buckets of letter triples, kept for the buckets that a language has.

    Bucket ``b`` has the entries ``starts[b]`` to ``starts[b + 1]`` of ``language`` and ``above``: by how much
    its log likelihood lies above ``floor``, the language's for a bucket without a count.
    """

    languages: list[str]
    floor: np.ndarray
    starts: np.ndarray
    language: np.ndarray
    above: np.ndarray

    def __post_init__(self) -> None:
        # the languages with the most entries get a column each, which is faster; the others keep theirs by bucket
        entries = np.bincount(self.language, minlength=len(self.languages))
        self.columns = np.sort(np.argsort(-entries, kind="stable")[:COLUMNS])
        often = np.isin(np.arange(len(self.languages)), self.columns)
        bucket = np.repeat(np.arange(BUCKETS), np.diff(self.starts))
        dense = often[self.language]
        self.table = np.zeros((len(self.columns), BUCKETS))
        self.table[np.searchsorted(self.columns, self.language[dense]), bucket[dense]] = self.above[dense]
        self.rest = np.r_[0, np.cumsum(np.bincount(bucket[~dense], minlength=BUCKETS))]
        self.rest_language, self.rest_above = self.language[~dense], self.above[~dense]

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log likelihoods for each text and language, and the texts' numbers of letters."""
        size = len(self.languages)
        total, letters = np.zeros((len(texts), size)), np.zeros(len(texts), np.int64)
        for rows, buckets in _triples_of(texts):
            letters += np.bincount(rows, minlength=len(texts))
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
            for column, language in zip(self.table, self.columns.tolist(), strict=True):
                total[rows[first], language] += np.add.reduceat(column.take(buckets), first) if len(first) else 0
            wide = self.rest[buckets + 1] - self.rest[buckets]
            if wide.any():
                ends = np.cumsum(wide)
                entry = np.arange(ends[-1]) + np.repeat(self.rest[buckets] - ends + wide, wide)
                place = np.repeat(rows * size, wide) + self.rest_language[entry]
                total += np.bincount(place, self.rest_above[entry], total.size).reshape(total.shape)
        return total + letters[:, None] * self.floor, letters


def _triples_of(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and buckets of all triples, in parts of about ``_CHUNK`` letters."""
    rows, found, held = [], [], 0
    for row, text in enumerate(texts):
        for buckets, n in _triples(text):
            rows.append(np.full(n, row))
            found.append(buckets)
            held += n
            if held >= _CHUNK:
                yield np.concatenate(rows), np.concatenate(found)
                rows, found, held = [], [], 0
    if rows:
        yield np.concatenate(rows), np.concatenate(found)


def _triples(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Buckets of the triples around each letter of the lower-cased text, and how many letters; in parts.

    Anything but a letter counts as a space; beyond Latin, Greek and Cyrillic every character counts
    as a letter.
    """
    for start in range(0, len(text), _CHUNK):
        part = text[max(0, start - 1) : start + _CHUNK + 1].lower()
        codes = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = _LETTER[np.minimum(codes, len(_LETTER) - 1)]
        codes = np.where(letter, codes, 32)
        middle = letter[1:-1]
        mixed = (codes[:-2] * 1_000_003 + codes[1:-1]) * 1_000_033 + codes[2:]
        mixed ^= mixed >> 21
        yield (mixed[middle] * 0x9E3779B1 >> 7) % BUCKETS, int(middle.sum())


_LETTER = np.array([chr(c).isalpha() for c in range(0x530)] + [True])
#: The same as a pattern for Spark: a letter, or anything beyond Cyrillic.
_HAS_LETTER = r"[\p{L}\x{530}-\x{10FFFF}]"


def _lowest(wanted: int, among: int) -> int:
    """The signed 64-bit bound below which about ``wanted`` of ``among`` evenly spread hashes lie."""
    return (1 << 63) - 1 if wanted >= among else (wanted << 64) // among - (1 << 63)


def train_text_model(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", *, sample_docs: int = SAMPLE_DOCS
) -> TextModel:
    """A model counted on up to ``sample_docs`` labelled rows of each label; rows without label or letter are no use.

    The languages are all labels of usable rows, however rare. A label's sample is the rows with its
    lowest hashes of id and text; rows equal in both count once, null ids are ids. All samples together
    have ``SAMPLE_TOTAL`` rows, or one for each label where there are more labels. Three aggregates find
    them: how many different hashes a label has (approximate), from that a bound below which about three
    times the sample lies, and the last hash of the sample among those. Counts are summed on the executors.
    What the driver gets is one row per label, and the buckets that occur in the samples. Without any
    usable row the model knows no language; an empty table has none.
    """
    rows = labelled.select(F.lower(F.trim(F.col(label_col))).alias("_lang"), F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    rows = rows.where(F.col("_lang").isNotNull() & (F.col("_lang") != "") & F.col("_text").rlike(_HAS_LETTER))
    rows = rows.select("_lang", "_text", F.xxhash64("_id", "_text").alias("_hash"))
    labels = {lang: n for lang, n in rows.groupBy("_lang").agg(F.approx_count_distinct("_hash")).collect()}
    languages = sorted(labels)
    if not languages:
        return TextModel([], np.zeros(0), np.zeros(BUCKETS + 1, np.int64), np.zeros(0, np.int32), np.zeros(0))
    sample_docs = max(1, min(sample_docs, SAMPLE_TOTAL // len(languages)))
    bounds = [(lang, _lowest(3 * sample_docs + 100, n)) for lang, n in labels.items()]
    low = rows.join(F.broadcast(rows.sparkSession.createDataFrame(bounds, "_lang string, _bound long")), "_lang").where("_hash <= _bound")
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_hash"))
    ends = low.select("_lang", "_hash").distinct().withColumn("_place", place).where(F.col("_place") <= sample_docs)
    last = ends.groupBy("_lang").agg(F.max("_hash").alias("_last")).collect()
    cuts = rows.sparkSession.createDataFrame([tuple(r) for r in last], "_lang string, _last long")
    chosen = rows.join(F.broadcast(cuts), "_lang").where("_hash <= _last").groupBy("_lang", "_hash").agg(F.first("_text").alias("_text"))
    chosen = chosen.select("_lang", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("_lang").to_pylist(), batch.column("_text"), strict=True):
                for buckets, _ in _triples(text.as_py()):
                    hit, n = np.unique(buckets, return_counts=True)
                    total.update({(lang, bucket): times for bucket, times in zip(hit.tolist(), n.tolist(), strict=True)})
                if len(total) > _CHUNK:
                    yield _counted(total)
                    total = Counter()
        yield _counted(total)

    counted = chosen.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    number = {lang: i for i, lang in enumerate(languages)}
    language = np.array([number[x] for x in found["lang"].to_pylist()], np.int32)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    order = np.lexsort((language, bucket))
    every = np.log(np.bincount(language, n, len(languages)) + SMOOTH * BUCKETS)
    starts = np.r_[0, np.cumsum(np.bincount(bucket, minlength=BUCKETS))]
    return TextModel(languages, np.log(SMOOTH) - every, starts, language[order], np.log((n[order] + SMOOTH) / SMOOTH))


def _counted(total: Counter[tuple[str, int]]) -> pa.RecordBatch:
    columns = [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int64()), pa.array(total.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])


def page_evidence(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``_id, _text, _declared, _address, _host`` of web pages: text without markup, the language that
    the markup declares, the one the address speaks for, and the host.
    """
    html, url = whole_text(F.col(html_col)), whole_text(F.col(url_col))
    no_text = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    path_language = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([A-Za-z]{2})(?:[-_/?#]|$)", 1))
    suffix = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    countries = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])
    return pages.select(
        F.col(id_col).alias("_id"),
        F.regexp_replace(html, no_text, " ").alias("_text"),
        F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([A-Za-z]{2,3})\b""", 1)).alias("_declared"),
        F.coalesce(countries[suffix], F.when(path_language != "", path_language)).alias("_address"),
        host.alias("_host"),
    )


def document_evidence(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The same for documents: their column for the language is the declaration, their source the host."""
    return docs.select(
        F.col(id_col).alias("_id"),
        whole_text(F.col(text_col)).alias("_text"),
        F.lower(F.trim(F.col(declared_col).cast("string"))).alias("_declared"),
        F.lit(None).cast("string").alias("_address"),
        F.lower(F.coalesce(F.col(source_col).cast("string"), F.lit(""))).alias("_host"),
    )


_EVIDENCE = ("_id", "_declared", "_address", "_host")


def _scored(evidence: DataFrame, model: TextModel) -> DataFrame:
    """The evidence with the text's letters, best language and tempered log likelihoods in place of the text.

    ``_langs`` and ``_score`` list the languages that the text leaves possible.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = max(1, _CHUNK // len(model.languages))
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                score, letters = model.scores(batch.column("_text").to_pylist())
                vote = pa.array(score.argmax(axis=1), pa.int32(), mask=letters == 0)
                score = TEXT_WEIGHT * (score - score.max(axis=1, keepdims=True))
                row, language = np.nonzero((score >= -IMPOSSIBLE) & (letters > 0)[:, None])
                ends = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=batch.num_rows))], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (language.astype(np.int32), score[row, language])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in _EVIDENCE), pa.array(letters, pa.int64()), vote, *lists],
                    names=[*_EVIDENCE, "_letters", "_vote", "_langs", "_score"],
                )

    kind = evidence.schema["_id"].dataType.simpleString()
    return evidence.mapInArrow(
        run, f"_id {kind}, _declared string, _address string, _host string, _letters long, _vote int, _langs array<int>, _score array<double>"
    )


def _listed(counts: DataFrame, key: str, name: str) -> DataFrame:
    """One row per ``key`` from its (``_vote``, ``_n``) rows, of which it has one per language at most: ``name`` lists them."""
    return counts.groupBy(key).agg(F.collect_list(F.struct(F.col("_vote").alias("language"), F.col("_n").alias("n"))).alias(name))


def _host_votes(scored: DataFrame) -> DataFrame:
    """``_host`` and the votes on it, on its domain and on its suffix, as lists; grouped sums, one row per vote until the end."""
    votes = scored.where("_vote is not null").groupBy("_host", "_vote").agg(F.count(F.lit(1)).alias("_n"))
    votes = cut(
        votes.withColumn("_domain", F.regexp_extract("_host", r"([^.]+\.[^.]+)$", 1)).withColumn("_suffix", F.regexp_extract("_host", r"([^.]+)$", 1))
    )
    hosts = scored.select("_host").distinct().withColumn("_domain", F.regexp_extract("_host", r"([^.]+\.[^.]+)$", 1))
    levels = hosts.withColumn("_suffix", F.regexp_extract("_host", r"([^.]+)$", 1))
    for key in ("_host", "_domain", "_suffix"):
        sums = votes.groupBy(key, "_vote").agg(F.sum("_n").alias("_n"))
        levels = levels.join(_listed(sums, key, f"_on{key}"), key, "left")
    return levels.select("_host", "_on_host", "_on_domain", "_on_suffix")


def _statements(scored: DataFrame, column: str, languages: DataFrame, place: str) -> tuple[DataFrame, dict[int, int]]:
    """Per language that ``column`` may state: its number as ``place`` and the votes of the texts where it is stated;
    and how many statements the texts of each language have. Anything but the model's languages is no statement."""
    stated = scored.where("_vote is not null").join(languages, F.col(column) == F.col("_name"))
    counts = cut(stated.groupBy(F.col("_number").alias(place), "_vote").agg(F.count(F.lit(1)).alias("_n")))
    size = counts.count()
    totals = {r["_vote"]: r["_n"] for r in counts.groupBy("_vote").agg(F.sum("_n").alias("_n")).collect()}
    listed = languages.select(F.col("_name").alias(column), F.col("_number").alias(place)).join(_listed(counts, place, f"{place}_votes"), place, "left")
    return (F.broadcast(listed) if size <= BROADCAST_COUNTS else listed), totals


def _dense(column: pa.Array, field: str, value: str, size: int) -> np.ndarray:
    """Lists of (language, value) as rows of a matrix; null lists are empty."""
    out = np.zeros((len(column), size))
    entries = column.flatten()
    row = np.repeat(np.arange(len(column)), np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64))
    out[row, pc.struct_field(entries, field).to_numpy()] = pc.struct_field(entries, value).to_numpy()
    return out


def _fused(batch: pa.RecordBatch, size: int, everywhere: np.ndarray, stated: list[np.ndarray], strength: float) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its posterior for each row."""
    rows = np.arange(batch.num_rows)
    vote = batch.column("_vote").fill_null(-1).to_numpy()
    votes, voting = np.zeros((len(rows), size)), vote >= 0
    votes[rows[voting], vote[voting]] = 1
    # from the most general level down: (votes without the own one + strength * prior above) / (sum + strength)
    prior = np.full((len(rows), size), 1 / size)
    for level in (None, "_on_suffix", "_on_domain", "_on_host"):
        counted = everywhere if level is None else _dense(batch.column(level), "language", "n", size)
        others = np.maximum(counted - votes, 0)
        prior = (others + strength * prior) / (others.sum(axis=1, keepdims=True) + strength)
    log = np.log(prior)
    langs, score = batch.column("_langs"), batch.column("_score")
    row = np.repeat(rows, pc.list_value_length(langs).to_numpy())
    text = np.full((len(rows), size), -np.inf)
    text[~voting] = 0
    text[row, langs.flatten().to_numpy()] = score.flatten().to_numpy()
    log += text
    for place, totals in zip(("_said", "_placed"), stated, strict=True):
        number = batch.column(place).fill_null(-1).to_numpy()
        says = number >= 0
        count = _dense(batch.column(f"{place}_votes"), "language", "n", size)[says] + 0.5
        count[np.arange(len(count)), number[says]] += 4.5
        log[says] += np.log(count / (totals + 0.5 * size + 4.5))
    best = log.argmax(axis=1)
    return best, 1 / np.exp(log - log[rows, best][:, None]).sum(axis=1)


def identify(evidence: DataFrame, model: TextModel, id_col: str, *, min_confidence: float = MIN_CONFIDENCE, prior_strength: float = PRIOR_STRENGTH) -> DataFrame:
    """``id_col, language, confidence, text_language, declared_language, address_language, host, letters,
    accepted`` for each row of ``page_evidence`` or ``document_evidence``.

    The posterior of a language is the product of its prior on the host, the tempered likelihood of
    the whole text, and the likelihoods of the declared and the address's language, whose reliability
    is counted over all rows. The host's prior comes from the text decisions of its other rows, with
    its domain, its suffix and all rows as fall-backs, each level smoothed by the next; all are
    grouped sums, joined back by host, and a row's own vote is taken out. Votes are counted one row per
    (host, language), so neither the plan nor the driver grows with the languages, but for one number each.

    A text without letters gives no vote and no text evidence and is rejected, as is a posterior below
    ``min_confidence``; so are null and empty texts. Null or unknown declarations are no evidence. A
    null or empty host is a host of its own. Ties go to the language first in the alphabet. Repeated
    rows and null ids stay rows, an empty table gives an empty result. With a model that knows no
    language all are rejected.
    """
    size = len(model.languages)
    if not size:
        none = F.lit(None).cast("string")
        return evidence.select(
            F.col("_id").alias(id_col), none.alias("language"), F.lit(0.0).alias("confidence"), none.alias("text_language"),
            F.col("_declared").alias("declared_language"), F.col("_address").alias("address_language"), F.col("_host").alias("host"),
            F.lit(0).cast("long").alias("letters"), F.lit(False).alias("accepted"),
        )
    spark = evidence.sparkSession
    languages = _language_table(spark, model.languages)
    scored = cut(_scored(evidence, model))
    declared, of_declared = _statements(scored, "_declared", languages, "_said")
    address, of_address = _statements(scored, "_address", languages, "_placed")
    everywhere = {r["_vote"]: r["_n"] for r in scored.groupBy("_vote").agg(F.count(F.lit(1)).alias("_n")).collect() if r["_vote"] is not None}
    # stored, so that both sides of the join are shuffled for it and a hot host's rows can be split
    hosts = stored(_host_votes(scored)).withColumnRenamed("_host", "_on")
    rows = scored.join(hosts, F.col("_host").eqNullSafe(F.col("_on")), "left").join(declared, "_declared", "left").join(address, "_address", "left")
    vectors = [np.array([found.get(i, 0) for i in range(size)], float) for found in (everywhere, of_declared, of_address)]
    needed = ["_vote", "_langs", "_score", "_on_suffix", "_on_domain", "_on_host", "_said", "_said_votes", "_placed", "_placed_votes"]
    passed = ["_id", "_declared", "_address", "_host", "_letters"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(model.languages, pa.string())
        for whole in batches:
            step = max(1, _CHUNK // size)
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                best, confidence = _fused(batch, size, vectors[0], vectors[1:], prior_strength)
                letters = batch.column("_letters").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"),
                        names.take(pa.array(best)),
                        pa.array(confidence),
                        names.take(batch.column("_vote")),
                        names.take(batch.column("_said")),
                        names.take(batch.column("_placed")),
                        batch.column("_host"),
                        batch.column("_letters"),
                        pa.array((letters > 0) & (confidence >= min_confidence)),
                    ],
                    names=["_id", "language", "confidence", "text_language", "declared_language", "address_language", "host", "letters", "accepted"],
                )

    kind = evidence.schema["_id"].dataType.simpleString()
    strings = "language string, confidence double, text_language string, declared_language string, address_language string, host string"
    fused = rows.select(*passed, *needed).mapInArrow(run, f"_id {kind}, {strings}, letters long, accepted boolean")
    return fused.withColumnRenamed("_id", id_col)


def _language_table(spark: SparkSession, languages: list[str]) -> DataFrame:
    named = spark.createDataFrame([(name, i) for i, name in enumerate(languages)], "_name string, _number int")
    return F.broadcast(named) if len(languages) <= BROADCAST_COUNTS else named
