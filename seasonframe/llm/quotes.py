"""Conversations in reply order, from the passages that messages quote; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonframe.llm.common import cut, whole_text

#: A quoted line, and a line that announces a quote (fixed values).
QUOTED = r"^[ \t]{0,3}>"
ANNOUNCES = r"(?i)\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"
#: Where a sentence of a normalised passage ends (fixed values).
SENTENCE_END = r"""(?<=[.!?…]["'”’)\]]{0,2}) |(?<=[。！？]) ?"""


def lines_of(text: Column) -> Column:
    return F.split(text, r"\r?\n", -1)


def _is_quoted(line: Column) -> Column:
    return line.rlike(QUOTED)


def quote_level(line: Column) -> Column:
    """How many marks stand before the line's content; 0 for a line that is not quoted."""
    marks = F.regexp_replace(F.regexp_extract(line, r"^[ \t>]*", 0), "[^>]", "")
    return F.when(_is_quoted(line), F.length(marks)).otherwise(0)


def without_marks(line: Column) -> Column:
    return F.when(_is_quoted(line), F.regexp_replace(line, r"^[ \t>]*", "")).otherwise(line)


def normalised_passage(text: Column) -> Column:
    """Lower case, white space runs as one space, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _sentences(passage: Column) -> Column:
    return F.filter(F.transform(F.split(passage, SENTENCE_END, -1), F.trim), lambda x: x != "")


def _sentences_of_lines(lines: Column) -> Column:
    return F.flatten(F.transform(lines, _sentences))


def _not_empty(lines: Column) -> Column:
    return F.filter(F.transform(lines, normalised_passage), lambda x: x != "")


def without_quotes(text: Column) -> Column:
    """The text's own lines: quoted ones go, and so does a line that announces the quote right below it."""
    lines = lines_of(text)
    own = F.filter(
        lines, lambda line, i: ~_is_quoted(line) & ~(line.rlike(ANNOUNCES) & F.coalesce(_is_quoted(F.get(lines, i + 1)), F.lit(False)))
    )
    return F.trim(F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", ""))


def quoted_passages(messages: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys, level, place, passage, lines`` for each paragraph that a message quotes, normalised.

    A paragraph ends where the quote level changes, at a line without content, and at a line that is
    not quoted. Only messages with a quote are taken apart.
    """
    # find the mark at a line's start without a multi-line pattern over the whole text
    with_quotes = messages.where(F.exists(lines_of(F.col(text_col)), _is_quoted))
    lines = with_quotes.select(*keys, F.xxhash64(text_col).alias("_version"), F.posexplode(lines_of(F.col(text_col))).alias("_line", "_text")).distinct()
    lines = lines.withColumn("level", quote_level(F.col("_text"))).withColumn("_content", without_marks(F.col("_text")))
    in_order = Window.partitionBy(*keys, "_version").orderBy("_line")
    blank = F.trim(F.regexp_replace("_content", r"\s+", " ")) == ""
    starts = (F.col("level") != F.lag("level").over(in_order)) | blank
    lines = lines.withColumn("_starts", F.coalesce(starts, F.lit(True)).cast("int"))
    lines = lines.withColumn("place", F.sum("_starts").over(in_order))
    return (
        lines.where(F.col("level") > 0)
        .groupBy(*keys, "_version", "level", "place")
        .agg(F.array_sort(F.collect_list(F.struct("_line", "_content"))).alias("_all"))
        .withColumn("lines", _not_empty(F.transform("_all", lambda x: x["_content"])))
        .withColumn("passage", F.array_join("lines", " "))
        .where(F.col("passage") != "")
        .select(*keys, "level", "place", "passage", "lines")
    )


def _own_paragraphs(text: Column) -> Column:
    plain = F.array_join(F.transform(lines_of(text), lambda x: F.when(_is_quoted(x), "").otherwise(x)), "\n")
    return F.split(plain, r"\n\s*\n", -1)


def own_passages(messages: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys, passage`` for each paragraph that a message itself says, normalised."""
    return (
        messages.select(*keys, F.explode(_own_paragraphs(F.col(text_col))).alias("_paragraph"))
        .select(*keys, normalised_passage(F.col("_paragraph")).alias("passage"))
        .where(F.col("passage") != "")
    )


def _own_pieces(messages: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys, way, paragraph, place, piece``: the lines, the sentences, and the sentences within each line."""
    paragraphs = messages.select(*keys, F.posexplode(_own_paragraphs(F.col(text_col))).alias("paragraph", "_paragraph"))
    lines = _not_empty(lines_of(F.col("_paragraph")))
    ways = F.array(lines, _sentences(normalised_passage(F.col("_paragraph"))), _sentences_of_lines(lines))
    return paragraphs.select(*keys, "paragraph", F.posexplode(ways).alias("way", "_pieces")).select(
        *keys, "way", "paragraph", F.posexplode("_pieces").alias("place", "piece")
    )


def first_holding(told: DataFrame, runs: DataFrame) -> DataFrame:
    """``conv, lines, held``: the first turn that itself says all pieces of a run (``conv, lines``) in their order.

    Pieces are the run's lines, its sentences, or the sentences within its lines, each a whole line or
    sentence of the message, and no two overlap there; what stands between them may be left out.
    Runs and texts that are equal are compared once. A run of one piece takes the first turn that says it,
    from combined rows. A longer one meets the texts that have its rarest piece, by hash; what meets is
    compared in full. Runs without such a turn are left out.
    """
    lines = F.col("lines")
    ways = F.array_distinct(F.array(lines, _sentences(F.array_join(lines, " ")), _sentences_of_lines(lines)))
    tried = runs.select("conv", "lines", F.explode(ways).alias("pieces"))
    tried = cut(tried.withColumn("run", F.md5(F.array_join("pieces", "\n"))))
    several = tried.where(F.size("pieces") > 1)
    wanted = several.select("conv", "run", F.explode("pieces").alias("_piece")).select("conv", "run", F.xxhash64("_piece").alias("hash")).distinct()

    single = tried.where(F.size("pieces") == 1).select("conv", "run", F.get("pieces", F.lit(0)).alias("piece")).distinct()
    first = told.select("conv", "turn", "_text").join(single.select("conv").distinct(), "conv", "left_semi")
    first = _own_pieces(first, ["conv", "turn"], "_text").groupBy("conv", "piece").agg(F.min("turn").alias("_held"))
    single = single.join(first, ["conv", "piece"]).select("conv", "run", "_held")

    texts = told.select("conv", "turn", "_text", F.md5("_text").alias("text_id"))
    said = _own_pieces(texts, ["conv", "turn", "text_id"], "_text").select("conv", F.xxhash64("piece").alias("hash"), "text_id", "turn")
    said = said.join(wanted.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi")
    said = cut(said.groupBy("conv", "hash", "text_id").agg(F.min("turn").alias("turn")))
    often = said.groupBy("conv", "hash").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (
        wanted.join(often, ["conv", "hash"], "left")
        .groupBy("conv", "run")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "hash")).alias("_rarest"))
        .where(F.col("_rarest.n") > 0)
        .select("conv", "run", F.col("_rarest.hash").alias("hash"))
    )
    meetings = cut(rarest.join(said, ["conv", "hash"]).select("conv", "run", "text_id", "turn"))

    # what the texts say, each piece with where it starts and ends among the characters that are not spaces
    met = texts.join(meetings.select("conv", "text_id").distinct(), ["conv", "text_id"], "left_semi").dropDuplicates(["conv", "text_id"])
    in_order = Window.partitionBy("conv", "text_id", "way").orderBy("paragraph", "place")
    pieces = _own_pieces(met, ["conv", "text_id"], "_text").withColumn("_long", F.length(F.regexp_replace("piece", " ", "")))
    pieces = pieces.withColumn("end", F.sum("_long").over(in_order)).withColumn("start", F.col("end") - F.col("_long"))
    texts_said = pieces.groupBy("conv", "text_id").agg(F.array_sort(F.collect_set(F.struct("end", "start", "piece"))).alias("_said"))

    # the piece that ends first is taken each time, so a run that fits is found
    def further(at: Column, x: Column) -> Column:
        fits = (x["piece"] == F.get(F.col("pieces"), at["n"])) & (x["start"] >= at["end"])
        return F.when(fits, F.struct((at["n"] + 1).alias("n"), x["end"].alias("end"))).otherwise(at)

    none = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("end"))
    compared = meetings.join(texts_said, ["conv", "text_id"]).join(several.select("conv", "run", "pieces").dropDuplicates(["conv", "run"]), ["conv", "run"])
    holding = compared.where(F.aggregate("_said", none, further)["n"] == F.size("pieces")).groupBy("conv", "run").agg(F.min("turn").alias("_held"))
    holding = holding.unionByName(single)
    return tried.join(holding, ["conv", "run"]).groupBy("conv", "lines").agg(F.min("_held").alias("held"))


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """``conv, turn, level, place, passage, source_turn`` for each quoted paragraph.

    ``source_turn`` is the first turn of the same conversation that says the paragraph, if it comes
    before the quoting one. Else it is the first turn before the quoting one that says all its lines or
    sentences in their order (``first_holding``): parts of a paragraph, several paragraphs in one, and
    lines broken elsewhere. Else it is null. Passages meet by their hash and are equal in full.
    """
    told = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), whole_text(F.col(text_col)).alias("_text"))
    told = told.where(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    quotes = quoted_passages(told, ["conv", "turn"], "_text").withColumn("hash", F.xxhash64("passage"))
    first_said = (
        own_passages(told, ["conv", "turn"], "_text")
        .withColumn("hash", F.xxhash64("passage"))
        .groupBy("conv", "hash", "passage")
        .agg(F.min("turn").alias("_first"))
    )
    found = quotes.join(first_said, ["conv", "hash", "passage"], "left")
    found = cut(found.withColumn("_source", F.when(F.col("_first") < F.col("turn"), F.col("_first"))))
    source = F.col("_source")
    runs = cut(found.where(source.isNull()).select("conv", "lines").distinct())
    if not runs.isEmpty():
        found = found.join(first_holding(told, runs), ["conv", "lines"], "left")
        source = F.coalesce(source, F.when(F.col("held") < F.col("turn"), F.col("held")))
    return found.select("conv", "turn", "level", "place", "passage", source.alias("source_turn"))


def _threads(parents: DataFrame) -> DataFrame:
    """``conv, turn, root, depth`` of the messages with a parent, by pointer doubling.

    Every round doubles the steps that a pointer spans, so rounds grow with the logarithm of the
    longest chain of replies.
    """
    now = cut(parents.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        further = now.select("conv", F.col("turn").alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        joined = cut(now.join(further, ["conv", "root"], "left"))
        moved = joined.where(F.col("_root").isNotNull()).limit(1).count()
        now = joined.select(
            "conv", "turn", F.coalesce("_root", "root").alias("root"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")
        )
        if not moved:
            return now


def reply_ordered(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per message: ``conv_col, turn_col, role_col, text_col`` without quotes, ``parent_turn,
    thread_turn, depth, n_quotes, n_linked, chat_line``.

    A message answers the message whose paragraph, lines or sentences it quotes at the outermost level
    that links, the first such in its text. ``thread_turn`` is the message at the end of that chain and ``depth`` its
    length; messages that quote nothing start threads. Ordered by ``conv_col, thread_turn, depth,
    turn_col``, a conversation reads so that every message follows the one it answers. No
    conversation is gathered in one row or task, so its length has no limit.

    Null texts count as empty. Messages with a null conversation or turn are linked to nothing.
    Rows that repeat a conversation and turn are one message with all their quotes, and stay rows.
    A null role reads ``user``. Extra columns are ignored; an empty table gives an empty result.
    """
    links = cut(link_quotes(messages, conv_col, turn_col, text_col))
    best = F.min(F.when(F.col("source_turn").isNotNull(), F.struct("level", "place", "source_turn")))
    answers = links.groupBy("conv", "turn").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("source_turn").alias("n_linked"), best.alias("_best")
    )
    answers = cut(answers.select("conv", "turn", "n_quotes", "n_linked", F.col("_best.source_turn").alias("parent")))
    threads = _threads(answers.where(F.col("parent").isNotNull()))
    placed = answers.join(threads, ["conv", "turn"], "left")
    own = without_quotes(whole_text(F.col(text_col)))
    rows = messages.select(F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"), F.col(role_col).alias("_role"), own.alias("_own"))
    rows = rows.join(placed, (F.col("_conv") == F.col("conv")) & (F.col("_turn") == F.col("turn")), "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        F.col("_conv").alias(conv_col),
        F.col("_turn").alias(turn_col),
        F.col("_role").alias(role_col),
        F.col("_own").alias(text_col),
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "_turn").alias("thread_turn"),
        F.coalesce("depth", zero).alias("depth"),
        F.coalesce("n_quotes", zero).alias("n_quotes"),
        F.coalesce("n_linked", zero).alias("n_linked"),
        F.concat(F.coalesce("_role", F.lit("user")), F.lit(": "), F.col("_own")).alias("chat_line"),
    )
