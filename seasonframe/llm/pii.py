"""Personal data by fixed rules and a skip-chain conditional random field over each document."""

from __future__ import annotations

import bisect
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonframe.llm.common import whole_text

#: Kinds in the order of reports; the field's label 0 is "none of them".
KINDS = ("email", "ip", "card", "phone")
#: Documents that the field's weights are counted on, the lowest by the hash of their id.
SAMPLE_DOCS = 4000
#: Rounds of message passing at most, the change that ends them, and the share of an old message kept.
MAX_ROUNDS = 50
TOLERANCE = 1e-4
DAMPING = 0.3
#: Counts that a mention is taken to start with: a number that breaks its rule and has no twin that keeps one,
#: and an address of letters that is one.
LONE_NUMBERS, PLAIN_ADDRESSES = 10, 20
#: Log odds that a span found by rule has its kind.
CERTAIN = 12.0
#: Digits at the end that make two numbers similar.
SIMILAR_DIGITS = 7

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+")
_AT = re.compile(r"[\[(]\s?at\s?[\])]", re.IGNORECASE)
#: A bare dot joins two labels only where nothing stands beside it, otherwise it ends a sentence.
_SPOKEN = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\s{0,3}[\[(]\s?at\s?[\])]\s{0,3}[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.|\s{0,3}[\[(]\s?dot\s?[\])]\s{0,3})[A-Za-z0-9-]{1,63}){1,8}",
    re.IGNORECASE,
)
_DIGIT = re.compile("[0-9]")
_NOT_DIGITS = re.compile("[^0-9]+")

Span = tuple[int, int, int]  # kind (place in KINDS), start, end


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from the @ signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _is_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))


def _is_card(found: str) -> bool:
    digits = [ord(c) - 48 for c in reversed(found) if c not in " -"]
    if not 13 <= len(digits) <= 19:
        return False
    doubled = (d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits))
    return sum(doubled) % 10 == 0


def _is_phone(found: str) -> bool:
    return 9 <= len(_NOT_DIGITS.sub("", found)) <= 15


def rule_spans(text: str) -> list[Span]:
    """Spans found by rule, by kind and start: leftmost, non-overlapping within a kind, failing ones dropped."""
    found: list[Span] = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m.group())]
    found += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(m.group())]
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if _is_phone(m.group())]
    return found


def _merged(spans: Iterable[Span]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def other_mentions(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Numbers of some length and spelt-out addresses that no rule took."""
    digits, spoken = _DIGIT.search(text), _AT.search(text)
    if not digits and not spoken:
        return []
    taken, found, at = _merged(spans), [], 0
    for start, end in [*taken, (len(text), len(text))]:
        if start > at:
            if digits:
                found += [(m.start(), m.end()) for m in _NUMBER.finditer(text, at, start)]
            if spoken:
                found += [(m.start(), m.end()) for m in _SPOKEN.finditer(text, at, start)]
        at = max(at, end)
    kept: list[tuple[int, int]] = []
    for a, b in sorted(found):
        mention = text[a:b]
        if (kept and a < kept[-1][1]) or (not re.search("[A-Za-z]", mention) and len(_NOT_DIGITS.sub("", mention)) < SIMILAR_DIGITS):
            continue
        kept.append((a, b))
    return kept


def similarity_keys(mention: str) -> list[str]:
    """What a mention shares with its repetitions and look-alikes."""
    if re.search("[A-Za-z@]", mention):
        plain = re.sub(r"\s*[\[(]\s?at\s?[\])]\s*", "@", mention.lower())
        plain = re.sub(r"\s*[\[(]\s?dot\s?[\])]\s*", ".", plain)
        return ["=" + re.sub(r"\s+", "", plain)]
    digits = _NOT_DIGITS.sub("", mention)
    if len(digits) < SIMILAR_DIGITS:
        return ["=" + mention]
    return ["#" + digits, "~" + digits[-SIMILAR_DIGITS:]]


def shape(mention: str) -> str:
    """What the local evidence goes by: letters or not, and the number of digits."""
    if re.search("[A-Za-z@]", mention):
        return "letters"
    return f"{min(len(_NOT_DIGITS.sub('', mention)), 20)} digits{', dots' if mention.count('.') == 3 else ''}"


@dataclass
class Field:
    """Weights of the random field, as logarithms of smoothed counts."""

    local: dict[str, np.ndarray]  # shape -> log weight of each label
    step: np.ndarray  # label of a mention -> label of the next
    skip: float  # weight of one label for mentions that share a key
    doubt: float  # log odds against any kind for a number that breaks its rule

    def evidence(self, mention: str) -> np.ndarray:
        """Log weights of a mention that no rule took.

        A spelt-out address breaks no rule of its kind, so it is taken as an address of its shape; a
        number does, and is doubted as much as such numbers are without a twin in the sample.
        """
        own = self.local.get(shape(mention), np.zeros(1 + len(KINDS))).copy()
        if shape(mention) != "letters":
            own[1:] -= self.doubt
        return own


def field_from_counts(counts: dict[tuple[str, str], int]) -> Field:
    """The field that the counts of ``count_evidence`` give."""
    size = 1 + len(KINDS)
    by_shape: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(size))
    steps = np.zeros((size, size))
    agree = differ = 0
    twins, alone = 0, LONE_NUMBERS
    by_shape["letters"][1] = PLAIN_ADDRESSES
    for (what, value), n in counts.items():
        if what == "shape":
            name, _, label = value.rpartition("/")
            by_shape[name][int(label)] += n
        elif what == "step":
            before, _, after = value.partition("/")
            steps[int(before), int(after)] += n
        elif what == "number":
            twins, alone = (twins + n, alone) if value == "twin" else (twins, alone + n)
        elif value == "same":
            agree += n
        else:
            differ += n
    local = {name: np.log((n + 1) / (n.sum() + size)) for name, n in by_shape.items()}
    step = np.log((steps + 10) / (steps.sum(axis=1, keepdims=True) + 10 * size))
    step -= step.mean(axis=1, keepdims=True)
    skip = float(np.clip(np.log((agree + 20) / (differ + 1)), 2.0, 6.0))
    return Field(local, 0.25 * step, skip, float(np.log((alone + 1) / (twins + 1))))


def count_evidence(text: str) -> Counter[tuple[str, str]]:
    """Shapes, label steps and agreement of a document's mentions, labelled by rule.

    The rules say nothing of spelt-out addresses, so those are left out. Numbers that break their rule
    are counted by whether they repeat or resemble one that a rule found in the document.
    """
    spans = rule_spans(text)
    others = [(a, b, 0) for a, b in other_mentions(text, spans) if shape(text[a:b]) != "letters"]
    found = sorted([(a, b, 1 + k) for k, a, b in spans] + others)
    counts: Counter[tuple[str, str]] = Counter()
    ruled = {key for _, a, b in spans for key in similarity_keys(text[a:b])}
    last_of: dict[str, int] = {}
    before = None
    for a, b, label in found:
        counts["shape", f"{shape(text[a:b])}/{label}"] += 1
        if not label:
            counts["number", "twin" if ruled.intersection(similarity_keys(text[a:b])) else "alone"] += 1
        if before is not None:
            counts["step", f"{before}/{label}"] += 1
        before = label
        for key in similarity_keys(text[a:b]):
            if key in last_of and (label or last_of[key]):
                counts["skip", "same" if label == last_of[key] else "other"] += 1
            last_of[key] = label
    return counts


def pass_messages(local: np.ndarray, ends: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Marginals by loopy sum-product in logarithms: ``local`` per node, ``tables`` per edge ``ends``.

    All edges send in both directions at once; old and new messages are mixed until none changes.
    """
    nodes, labels = local.shape
    belief = local.copy()
    if len(ends):
        source, target = np.r_[ends[:, 0], ends[:, 1]], np.r_[ends[:, 1], ends[:, 0]]
        table = np.concatenate([tables, tables.transpose(0, 2, 1)])
        half = len(ends)
        back = np.r_[np.arange(half, 2 * half), np.arange(half)]
        message = np.zeros((2 * half, labels))
        for _ in range(MAX_ROUNDS):
            belief = local.copy()
            np.add.at(belief, target, message)
            sent = _log_sum((belief[source] - message[back])[:, :, None] + table, axis=1)
            sent -= _log_sum(sent, axis=1)[:, None]
            sent = DAMPING * message + (1 - DAMPING) * sent
            change = np.abs(sent - message).max()
            message = sent
            if change < TOLERANCE:
                break
        belief = local.copy()
        np.add.at(belief, target, message)
    return np.exp(belief - _log_sum(belief, axis=1)[:, None])


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    most = values.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(values - most).sum(axis=axis))


def field_spans(texts: list[str], spans: list[list[Span]], field: Field) -> list[list[Span]]:
    """What the field adds to the rules' spans in each text.

    Nodes are all mentions of a document in order, with a chain edge to the next. Mentions of equal
    or similar digits or address also meet in a node of their own, however far apart they are:
    through it they share one potential, with as many edges as mentions. Documents are
    independent, and one pass of messages serves many. A document needs no inference where the rules
    left no mention. Messages that have not settled after ``MAX_ROUNDS`` rounds are used as they are.
    """
    local: list[np.ndarray] = []
    chain: list[tuple[int, int]] = []
    skip: list[tuple[int, int]] = []
    open_nodes: list[tuple[int, int, int, int]] = []
    size = 1 + len(KINDS)
    for row, text in enumerate(texts):
        others = other_mentions(text, spans[row])
        if not others:
            continue
        hubs: dict[str, int] = {}
        before = None
        for a, b, label in sorted([(a, b, 1 + k) for k, a, b in spans[row]] + [(a, b, 0) for a, b in others]):
            node = len(local)
            if label:
                weights = np.full(size, -CERTAIN)
                weights[label] = 0.0
                local.append(weights)
            else:
                local.append(field.evidence(text[a:b]))
                open_nodes.append((node, row, a, b))
            if before is not None:
                chain.append((before, node))
            before = node
            for key in similarity_keys(text[a:b]):
                if key not in hubs:
                    hubs[key] = len(local)
                    local.append(np.zeros(size))
                skip.append((hubs[key], node))
    added: list[list[Span]] = [[] for _ in texts]
    if open_nodes:
        same = field.skip * np.eye(size)
        tables = np.concatenate([np.broadcast_to(field.step, (len(chain), size, size)), np.broadcast_to(same, (len(skip), size, size))])
        belief = pass_messages(np.array(local), np.array(chain + skip).reshape(-1, 2), tables)
        for node, row, a, b in open_nodes:
            label = int(belief[node].argmax())
            if label and belief[node, label] > 0.5:
                added[row].append((label - 1, a, b))
    return added


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample_docs: int = SAMPLE_DOCS) -> Field:
    """The field counted on up to ``sample_docs`` documents, the lowest by the hash of their id.

    Counts are summed on the executors; their number is bounded by the shapes and labels.
    """
    ids = docs.select(F.col(id_col).alias("_id")).orderBy(F.xxhash64("_id"), "_id").limit(sample_docs).distinct()
    chosen = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text")).join(
        F.broadcast(ids), "_id", "left_semi"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for text in batch.column("_text"):
                total.update(count_evidence(text.as_py()))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([total[k] for k in keys], pa.int64())],
            names=["what", "value", "n"],
        )

    counted = chosen.mapInArrow(run, "what string, value string, n long").groupBy("what", "value").agg(F.sum("n").alias("n"))
    return field_from_counts({(r["what"], r["value"]): r["n"] for r in counted.collect()})


def _spans_of(texts: list[str], field: Field) -> list[list[tuple[int, int, int, bool]]]:
    ruled = [rule_spans(t) for t in texts]
    added = field_spans(texts, ruled, field)
    return [sorted([(*s, True) for s in r] + [(*s, False) for s in a]) for r, a in zip(ruled, added, strict=True)]


def _text_batches(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Row number and texts of slices with a bounded number of mentions' bytes."""
    start, texts, held = 0, [], 0
    for i, text in enumerate(column):
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held > 4_000_000:
            yield start, texts
            start, texts, held = i + 1, [], 0
    if texts:
        yield start, texts


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample_docs: int = SAMPLE_DOCS, field: Field | None = None
) -> DataFrame:
    """``id_col, spans`` per row; spans: kind, start, end (code points, end exclusive) and ``by_rule``.

    The rules' spans always stay. The field adds spelt-out addresses, and numbers that break a rule but
    repeat or resemble what a rule found in the same document. A null text counts as empty and has no
    span; a null id and repeated rows are handled as rows of their own. An empty table gives an empty
    result. Extra columns are ignored.
    """
    weights = field or train(docs, id_col, text_col, sample_docs=sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("by_rule", pa.bool_())]))
        for batch in batches:
            for start, texts in _text_batches(batch.column("_text")):
                found = [
                    [{"kind": KINDS[k], "start": a, "end": b, "by_rule": rule} for k, a, b, rule in row] for row in _spans_of(texts, weights)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(start, len(texts)), pa.array(found, kind)], names=["_id", "spans"]
                )

    chosen = docs.select(F.col(id_col).alias("_id"), whole_text(F.col(text_col)).alias("_text"))
    kind = chosen.schema["_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run, f"_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,by_rule:boolean>>"
    ).withColumnRenamed("_id", id_col)


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined; spans are listed by kind and start."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample_docs: int = SAMPLE_DOCS, field: Field | None = None
) -> DataFrame:
    """The input with every span of personal data replaced by its kind, as in ``[EMAIL]``.

    Overlapping spans become one mark, named after the one that starts first. All columns stay, a
    null text stays null, and a text without a span is unchanged. Null ids and repeated rows are rows
    like any other; an empty table stays empty.
    """
    weights = field or train(docs, id_col, text_col, sample_docs=sample_docs)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            new: list[str | None] = []
            for start, texts in _text_batches(column):
                for i, (text, spans) in enumerate(zip(texts, _spans_of(texts, weights), strict=True)):
                    new.append(_marked(text, spans) if column[start + i].is_valid else None)
            changed = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(
                [changed if i == place else batch.column(i) for i in range(batch.num_columns)], names=batch.schema.names
            )

    return docs.mapInArrow(run, docs.schema)


def _marked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, at = [], 0
    ordered = sorted(spans, key=lambda s: (s[1], s[0]))
    starts = [s[1] for s in ordered]
    for a, b in _merged([(k, a, b) for k, a, b, _ in ordered]):
        first = ordered[bisect.bisect_left(starts, a)]
        out += [text[at:a], f"[{KINDS[first[0]].upper()}]"]
        at = b
    return "".join([*out, text[at:]])
