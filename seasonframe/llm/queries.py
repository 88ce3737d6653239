"""The registered queries of this subpackage on the driver's tables, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonframe.llm.bpe import encoding_digests
from seasonframe.llm.common import table
from seasonframe.llm.embedding_dedup import near_vectors
from seasonframe.llm.exact_dedup import exact_duplicates
from seasonframe.llm.html_text import extract_text
from seasonframe.llm.language import identify, page_evidence, train_text_model
from seasonframe.llm.merkle import manifest
from seasonframe.llm.packing import pack_documents
from seasonframe.llm.pieces import piece_digests
from seasonframe.llm.pii import KINDS, find_personal_data, joined_spans
from seasonframe.llm.quotes import reply_ordered
from seasonframe.llm.simhash import simhash_duplicates
from seasonframe.llm.spelling import spelling_groups, word_counts
from seasonframe.llm.suffix_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train_text_model(table(spark, sf_dir, "documents"))
    return identify(page_evidence(table(spark, sf_dir, "pages")), model, "page_id")


QUERIES["op1_language_id"] = op1_language_id


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), least=400).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # what is left, as text; where a removed run ends within a character its bytes become U+FFFD
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


QUERIES["op2_suffix_array_dedup"] = op2_suffix_array_dedup


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


QUERIES["op3_embedding_near_dedup"] = op3_embedding_near_dedup
SQL["op3_embedding_near_dedup"] = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v
        FROM embeddings
        WHERE label IS NOT NULL
          AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b
        FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ),
    reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ),
    least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
    degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN degree USING (vec_id)
"""


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))


QUERIES["op4_chat_formatting"] = op4_chat_formatting
SQL["op4_chat_formatting"] = r"""
    WITH RECURSIVE told AS (
        SELECT conv_id, turn, text, string_split_regex(text, '\r?\n') AS split
        FROM (SELECT DISTINCT conv_id, turn, coalesce(text, '') AS text FROM conversations)
    ),
    lines AS (
        SELECT conv_id, turn, text, pos, line, regexp_matches(line, '^[ \t]{0,3}>') AS quoted
        FROM (SELECT conv_id, turn, text, unnest(split) AS line, generate_subscripts(split, 1) AS pos FROM told)
    ),
    marked AS (
        SELECT *, CASE WHEN quoted THEN length(regexp_replace(regexp_extract(line, '^[ \t>]*'), '[^>]', '', 'g')) ELSE 0 END AS level,
               CASE WHEN quoted THEN regexp_replace(line, '^[ \t>]*', '') ELSE line END AS content
        FROM lines
    ),
    cut AS (
        SELECT *, CASE WHEN level = lag(level) OVER w AND trim(regexp_replace(content, '\s+', ' ', 'g')) <> '' THEN 0 ELSE 1 END AS starts
        FROM marked WINDOW w AS (PARTITION BY conv_id, turn, text ORDER BY pos)
    ),
    placed AS (SELECT *, sum(starts) OVER (PARTITION BY conv_id, turn, text ORDER BY pos) AS place FROM cut),
    quotes AS (
        SELECT * FROM (
            SELECT conv_id, turn, level, place,
                   lower(trim(regexp_replace(string_agg(content, ' ' ORDER BY pos), '\s+', ' ', 'g'))) AS passage,
                   list_filter(list_transform(list(content ORDER BY pos), lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g')))), lambda x: x <> '') AS lines
            FROM placed WHERE level > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn, text, level, place)
        WHERE passage <> ''
    ),
    own AS (
        SELECT conv_id, turn, text, string_agg(CASE WHEN quoted THEN '' ELSE line END, chr(10) ORDER BY pos) AS plain,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT quoted AND NOT announces), '') AS said
        FROM (
            SELECT *, regexp_matches(line, '(?i)\b(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$')
                      AND coalesce(lead(quoted) OVER (PARTITION BY conv_id, turn, text ORDER BY pos), false) AS announces
            FROM lines)
        GROUP BY conv_id, turn, text
    ),
    first_said AS (
        SELECT conv_id, passage, min(turn) AS first_turn
        FROM (SELECT conv_id, turn, lower(trim(regexp_replace(unnest(string_split_regex(plain, '\n\s*\n')), '\s+', ' ', 'g'))) AS passage
              FROM own WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
        WHERE passage <> '' GROUP BY conv_id, passage
    ),
    direct AS (
        SELECT q.conv_id, q.turn, level, place, lines, CASE WHEN first_turn < q.turn THEN first_turn END AS source_turn
        FROM quotes q LEFT JOIN first_said f ON f.conv_id = q.conv_id AND f.passage = q.passage
    ),
    -- the pieces of a run that no paragraph answers: its lines, its sentences, the sentences within its lines
    tried AS (
        SELECT conv_id, lines, unnest([lines, list_filter(list_transform(string_split(regexp_replace(regexp_replace(array_to_string(lines, ' '), '([.!?…]["''”’)\]]{0,2}) ', '\1' || chr(1), 'g'), '([。！？]) ?', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> ''),
                                       list_filter(list_transform(string_split(array_to_string(list_transform(lines, lambda x: regexp_replace(regexp_replace(x, '([.!?…]["''”’)\]]{0,2}) ', '\1' || chr(1), 'g'), '([。！？]) ?', '\1' || chr(1), 'g')), chr(1)), chr(1)), lambda x: trim(x)), lambda x: x <> '')]) AS pieces
        FROM (SELECT DISTINCT conv_id, lines FROM direct WHERE source_turn IS NULL)
    ),
    told_lines AS (
        SELECT conv_id, turn, text, paragraph,
               list_filter(list_transform(string_split_regex(body, '\r?\n'), lambda x: lower(trim(regexp_replace(x, '\s+', ' ', 'g')))), lambda x: x <> '') AS lines,
               lower(trim(regexp_replace(body, '\s+', ' ', 'g'))) AS whole
        FROM (SELECT conv_id, turn, text, unnest(parts) AS body, generate_subscripts(parts, 1) AS paragraph
              FROM (SELECT *, string_split_regex(plain, '\n\s*\n') AS parts FROM own WHERE conv_id IS NOT NULL AND turn IS NOT NULL))
    ),
    told_ways AS (
        SELECT conv_id, turn, text, paragraph, unnest(ways) AS pieces, generate_subscripts(ways, 1) AS way
        FROM (SELECT *, [lines, list_filter(list_transform(string_split(regexp_replace(regexp_replace(whole, '([.!?…]["''”’)\]]{0,2}) ', '\1' || chr(1), 'g'), '([。！？]) ?', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> ''),
                         list_filter(list_transform(string_split(array_to_string(list_transform(lines, lambda x: regexp_replace(regexp_replace(x, '([.!?…]["''”’)\]]{0,2}) ', '\1' || chr(1), 'g'), '([。！？]) ?', '\1' || chr(1), 'g')), chr(1)), chr(1)), lambda x: trim(x)), lambda x: x <> '')] AS ways
              FROM told_lines)
    ),
    told_pieces AS (
        SELECT conv_id, turn, text, way, piece, sum(length(replace(piece, ' ', ''))) OVER (PARTITION BY conv_id, turn, text, way ORDER BY paragraph, spot) AS stops,
               length(replace(piece, ' ', '')) AS long
        FROM (SELECT *, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS spot FROM told_ways)
    ),
    told_all AS (
        SELECT conv_id, turn, text, list({p: piece, a: stops - long, z: stops, n: 0::BIGINT} ORDER BY stops, stops - long, piece) AS spoken
        FROM (SELECT DISTINCT conv_id, turn, text, piece, stops, long FROM told_pieces) GROUP BY conv_id, turn, text
    ),
    held AS (
        SELECT t.conv_id, t.lines, min(a.turn) AS turn
        FROM tried t JOIN told_all a ON a.conv_id = t.conv_id
        WHERE list_reduce(list_prepend({p: '', a: 0::HUGEINT, z: 0::HUGEINT, n: 0::BIGINT}, spoken),
                  lambda s, x: CASE WHEN x.p = pieces[s.n + 1] AND x.a >= s.z THEN {p: '', a: 0::HUGEINT, z: x.z, n: s.n + 1} ELSE s END).n = len(pieces)
        GROUP BY t.conv_id, t.lines
    ),
    links AS (
        SELECT d.conv_id, d.turn, level, place, coalesce(source_turn, CASE WHEN h.turn < d.turn THEN h.turn END) AS source_turn
        FROM direct d LEFT JOIN held h ON h.conv_id = d.conv_id AND h.lines = d.lines
    ),
    answers AS (
        SELECT conv_id, turn, count(*) AS n_quotes, count(source_turn) AS n_linked,
               arg_min(source_turn, level * 1000000000 + place) FILTER (WHERE source_turn IS NOT NULL) AS parent
        FROM links GROUP BY conv_id, turn
    ),
    chain AS (
        SELECT conv_id, turn, parent AS up, 1 AS depth FROM answers WHERE parent IS NOT NULL
        UNION ALL
        SELECT c.conv_id, c.turn, a.parent, c.depth + 1
        FROM chain c JOIN answers a ON a.conv_id = c.conv_id AND a.turn = c.up WHERE a.parent IS NOT NULL
    ),
    threads AS (SELECT conv_id, turn, min(up) AS root, max(depth) AS depth FROM chain GROUP BY conv_id, turn),
    said AS (SELECT conv_id, turn, text, trim(regexp_replace(said, '^\s+|\s+$', '', 'g')) AS said FROM own)
    SELECT m.conv_id, m.turn, m.role, said.said AS text, a.parent AS parent_turn, coalesce(t.root, m.turn) AS thread_turn,
           CAST(coalesce(t.depth, 0) AS BIGINT) AS depth, coalesce(a.n_quotes, 0) AS n_quotes, coalesce(a.n_linked, 0) AS n_linked,
           coalesce(m.role, 'user') || ': ' || said.said AS chat_line
    FROM conversations m
    JOIN said ON said.conv_id IS NOT DISTINCT FROM m.conv_id AND said.turn IS NOT DISTINCT FROM m.turn AND said.text = coalesce(m.text, '')
    LEFT JOIN answers a ON a.conv_id = m.conv_id AND a.turn = m.turn
    LEFT JOIN threads t ON t.conv_id = m.conv_id AND t.turn = m.turn
"""


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


QUERIES["op5_html_extraction"] = op5_html_extraction


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest").drop("n_chunks")


QUERIES["op6_exact_dedup"] = op6_exact_dedup
SQL["op6_exact_dedup"] = """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES["op7_bpe_encoding"] = op7_bpe_encoding


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, most=3)


QUERIES["op8_simhash_near_dedup"] = op8_simhash_near_dedup


def _number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    by_rule = F.filter("spans", lambda s: s["by_rule"])
    counts = [_number_of(by_rule, kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined_spans(by_rule), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


QUERIES["op9_personal_data"] = op9_personal_data


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer, capacity=1024, end_id=2)


QUERIES["op10_best_fit_packing"] = op10_best_fit_packing


def op11_sentencepiece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES["op11_sentencepiece_encoding"] = op11_sentencepiece_encoding


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return manifest(
        table(spark, sf_dir, "documents"),
        fields=["doc_id", "source", "lang", "n_chars", "text"],
        changed={"text": F.translate("text", upper, upper.lower())},
        changed_where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
        proofs=False,
    ).drop("source")


QUERIES["op12_merkle_manifest"] = op12_merkle_manifest
SQL["op12_merkle_manifest"] = r"""
    WITH RECURSIVE crc_table AS (
        SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS step
        FROM range(256) AS t(b)
    ),
    leaves AS (
        SELECT doc_id, source,
               sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
                   || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               sha256(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
                   || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered,
               coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                   lambda c, d: xor(c >> 8, step[(xor(c, d) & 255) + 1])), 4294967295) % 5 = 0, false) AS tampered
        FROM documents, crc_table
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
    tree AS (
        SELECT source, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY source) AS nodes FROM placed
        UNION ALL
        SELECT source, level + 1, place // 16, sha256(string_agg(node, '' ORDER BY place)), (any_value(nodes) + 15) // 16
        FROM tree WHERE nodes > 1 GROUP BY source, level, place // 16
    ),
    subroots AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM tree WHERE nodes = 1),
    top AS (
        SELECT 0 AS level, place, subroot AS node, count(*) OVER () AS nodes FROM subroots
        UNION ALL
        SELECT level + 1, place // 16, sha256(string_agg(node, '' ORDER BY place)), (any_value(nodes) + 15) // 16
        FROM top WHERE nodes > 1 GROUP BY level, place // 16
    ),
    steps AS (
        SELECT p.source, p.place, t.level,
               coalesce(string_agg(t.node, '' ORDER BY t.place) FILTER (WHERE t.place < p.place // (16 ** t.level)::BIGINT), '') AS before,
               coalesce(string_agg(t.node, '' ORDER BY t.place) FILTER (WHERE t.place > p.place // (16 ** t.level)::BIGINT), '') AS after
        FROM placed p JOIN tree t ON t.source IS NOT DISTINCT FROM p.source AND t.nodes > 1 AND t.place // 16 = p.place // (16 ** (t.level + 1))::BIGINT
        GROUP BY p.source, p.place, t.level
    ),
    top_steps AS (
        SELECT s.source, t.level,
               coalesce(string_agg(t.node, '' ORDER BY t.place) FILTER (WHERE t.place < s.place // (16 ** t.level)::BIGINT), '') AS before,
               coalesce(string_agg(t.node, '' ORDER BY t.place) FILTER (WHERE t.place > s.place // (16 ** t.level)::BIGINT), '') AS after
        FROM subroots s JOIN top t ON t.nodes > 1 AND t.place // 16 = s.place // (16 ** (t.level + 1))::BIGINT
        GROUP BY s.source, t.level
    ),
    paths AS (
        SELECT p.doc_id, p.source, p.place, p.leaf, CASE WHEN tampered THEN lowered ELSE leaf END AS given,
               coalesce((SELECT list({b: before, a: after} ORDER BY level) FROM steps s WHERE s.source IS NOT DISTINCT FROM p.source AND s.place = p.place), [])
               || coalesce((SELECT list({b: before, a: after} ORDER BY level) FROM top_steps s WHERE s.source IS NOT DISTINCT FROM p.source), []) AS path
        FROM placed p
    ),
    folded AS (
        SELECT doc_id, source, leaf, path, 0 AS done, given AS node FROM paths
        UNION ALL
        SELECT doc_id, source, leaf, path, done + 1, sha256(path[done + 1].b || node || path[done + 1].a) FROM folded WHERE done < len(path)
    )
    SELECT f.doc_id, f.leaf, s.subroot, t.node AS root, sha256(list_aggregate(list_transform(path, lambda x: x.b || x.a), 'string_agg', '')) AS proof_sha256,
           f.node AS folded_root, f.node = t.node AS verified
    FROM folded f JOIN subroots s ON s.source IS NOT DISTINCT FROM f.source CROSS JOIN (SELECT node FROM top WHERE nodes = 1) t
    WHERE f.done = len(f.path)
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(table(spark, sf_dir, "documents"), shortest=7, least=2, slip_every=31)
    return spelling_groups(counts, times=10)


QUERIES["op13_spelling_variants"] = op13_spelling_variants
SQL["op13_spelling_variants"] = r"""
    WITH RECURSIVE crc_table AS (
        SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS step
        FROM range(256) AS t(b)
    ),
    runs AS (
        SELECT doc_id, run, count(*) AS times
        FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents)
        GROUP BY doc_id, run
    ),
    marked AS (
        SELECT run, times,
               xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(coalesce(doc_id::VARCHAR, '') || ':' || run), '..'),
                       lambda h: (strpos('0123456789ABCDEF', h[1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2]) - 1)),
                   lambda c, d: xor(c >> 8, step[(xor(c, d) & 255) + 1])), 4294967295) AS mark
        FROM runs, crc_table
    ),
    words AS (
        SELECT word, sum(times)::BIGINT AS n
        FROM (SELECT CASE WHEN mark % 31 = 0 THEN substr(run, 1, mark % length(run)) || substr(run, mark % length(run) + 2) ELSE run END AS word, times FROM marked)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
    ),
    skips AS (SELECT word, n, substr(word, 1, i) AS before, substr(word, i + 2) AS after FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
    near AS (
        SELECT s.word, t.word AS other, t.n FROM skips s JOIN skips t ON s.before = t.before AND s.after = t.after AND s.word <> t.word
        UNION SELECT s.word, w.word, w.n FROM skips s JOIN words w ON w.word = s.before || s.after
        UNION SELECT w.word, s.word, s.n FROM skips s JOIN words w ON w.word = s.before || s.after
    ),
    counted AS (SELECT word, count(*) AS n_near, first({w: other, n: n} ORDER BY n DESC, other) AS best FROM near GROUP BY word),
    forms AS (SELECT w.word, c.best.w AS form, c.best.n AS form_n FROM words w JOIN counted c ON c.word = w.word WHERE c.best.n >= 10 * w.n),
    chain AS (
        SELECT word, form AS leads, 1 AS steps FROM forms
        UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN forms f ON f.word = c.leads
    ),
    roots AS (SELECT word, arg_max(leads, steps) AS root FROM chain GROUP BY word)
    SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(c.n_near, 0) AS n_near, f.form_n
    FROM words w LEFT JOIN counted c ON c.word = w.word LEFT JOIN forms f ON f.word = w.word LEFT JOIN roots r ON r.word = w.word
"""
