"""One registered query per training-data operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm import attention_lm, byte_bpe, language_id, lexical_search, line_dedup, mixing, nearest, ngram_join, order_minhash, packing, spelling, token_counts, tool_calls
from tickweave.llm.common import documents


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentencepiece token counts of every whole text."""
    return token_counts.count_tokens(documents(spark, sf_dir))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text, learned from the documents not held out."""
    return language_id.identify(documents(spark, sf_dir))


def op2_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Self-attention and unigram scores of every whole text."""
    return attention_lm.score(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text in sequences of at most 2048 tokens."""
    return packing.with_crc32(packing.pack(documents(spark, sf_dir)))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every whole text without its repeated lines."""
    return line_dedup.line_digests(documents(spark, sf_dir))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows by cosine of every fiftieth vector."""
    return nearest.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls and results derived from all conversations, linked, ordered and checked."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return tool_calls.link_tool_calls(*tool_calls.calls_of_conversations(spark, turns))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids and decoded bytes of every whole text, as digests."""
    return byte_bpe.encode_documents(documents(spark, sf_dir), with_ids=False)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have Jaccard 0.85 or more."""
    return ngram_join.link(documents(spark, sf_dir))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of every whole text and of its edited text."""
    return order_minhash.edit_digests(documents(spark, sf_dir))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix of sources to their target weights takes of every document."""
    return mixing.taken(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring of all documents for every benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.search(items, documents(spark, sf_dir)).drop("text_key")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all whole texts with their forms, one in 31 (document, word) pairs misspelt."""
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_attention_lm, op3_packing, op4_token_counts, op5_line_dedup, op6_nearest, op7_tool_calls, op8_byte_bpe, op9_ngram_join, op10_order_minhash, op11_mixing, op12_lexical_search, op13_spelling)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The others learn from the text, follow a tokenizer, draw or search approximately; their tests
#: hold them against plain rules, the libraries, held-out accuracy and brute force.
ORACLE = {
    "op5_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(string_split({_LOWER}, chr(10))) AS low,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents),
        keyed AS (SELECT doc_id, pos, line, trim(low, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines),
        heavy AS (SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (SELECT k.*, h.key IS NOT NULL AND h.top <> k.doc_id AS gone FROM keyed k LEFT JOIN heavy h ON k.key = h.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op7_tool_calls": """
        WITH RECURSIVE t AS (
            SELECT conv_id, turn, role, text, length(text) AS n, 'call-' || conv_id || '-' || turn AS call_id,
                   ['search', 'summarize', 'translate', 'draw'][1 + (conv_id + turn) % 4] AS name FROM conversations),
        c AS (SELECT * FROM t WHERE role = 'assistant'),
        d AS (
            SELECT conv_id, turn, 0 AS depth FROM c WHERE NOT EXISTS (SELECT 1 FROM c p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
            UNION ALL SELECT c.conv_id, c.turn, depth + 1 FROM c JOIN d ON c.conv_id = d.conv_id AND c.turn = d.turn + 2),
        a AS (
            SELECT conv_id, turn, call_id, name, CAST(depth AS BIGINT) AS depth,
                   row_number() OVER (PARTITION BY conv_id ORDER BY depth, turn, call_id) AS position,
                   CASE WHEN n % 13 = 0 THEN NULL
                        WHEN name = 'search' THEN '{' || CASE WHEN n % 5 = 0 THEN '"limit":"' || n || '",' ELSE '' END || '"query":' || to_json(text) || '}'
                        WHEN name = 'summarize' THEN '{' || CASE WHEN n % 3 > 0 THEN '"ratio":0.5,' ELSE '' END || '"text":'
                             || to_json(CASE WHEN n % 7 = 0 THEN 'seven' ELSE text END) || '}'
                        ELSE '{' || CASE WHEN n % 11 = 0 THEN '"extra":true,' ELSE '' END || '"options":{"chars":' || n || ',"to":"en"},"text":'
                             || to_json(text) || '}' END AS arguments,
                   CASE WHEN n % 13 = 0 THEN '' WHEN name = 'search' AND n % 5 = 0 THEN 'type:limit'
                        WHEN name = 'summarize' AND n % 3 = 0 THEN 'missing:ratio'
                        WHEN name = 'translate' AND n % 11 = 0 THEN 'unknown:extra' ELSE '' END AS errors
            FROM c JOIN d USING (conv_id, turn)),
        r AS (
            SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, count(*) AS n_results, first(text) AS content
            FROM t WHERE role <> 'assistant' AND turn > 0 GROUP BY ALL),
        j AS (
            SELECT coalesce(a.conv_id, r.conv_id) AS conv_id, position, coalesce(a.call_id, r.call_id) AS call_id, name, depth, arguments, content,
                   coalesce(errors, '') AS errors, coalesce(n_results, 0) AS n_results,
                   CASE WHEN a.call_id IS NULL THEN 'orphan_result' WHEN name = 'draw' THEN 'unknown_tool' WHEN arguments IS NULL THEN 'bad_json'
                        WHEN errors <> '' THEN 'invalid' WHEN n_results IS NULL THEN 'no_result' ELSE 'ok' END AS status
            FROM a FULL JOIN r ON a.conv_id = r.conv_id AND a.call_id = r.call_id)
        SELECT conv_id, position, call_id, name, depth, status, errors, n_results,
               '{"arguments":' || coalesce(arguments, 'null') || ',"id":' || to_json(call_id) || ',"name":' || coalesce(CAST(to_json(name) AS VARCHAR), 'null')
               || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"status":' || to_json(status) || '}' AS message
        FROM j""",
    "op9_ngram_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array({_LOWER}, '[ \t\n\x0b\x0c\r]+') IF x <> ''] AS words FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                   ELSE list_distinct([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]) END AS set
            FROM w),
        g AS (SELECT doc_id, len(set) AS n, unnest(set) AS gram FROM s),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (max(a.n) + max(b.n) - count(*))),
        reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a)
        SELECT s.doc_id, len(s.set) AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
        FROM s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.set""",
    "op12_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        i AS (
            SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
        p AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
        f AS (
            SELECT item_id, doc, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM f WHERE score > 0 QUALIFY rank <= 10""",
    "op13_spelling": r"""
        WITH RECURSIVE tab AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM range(256) r(i))),
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
            FROM documents),
        long AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
        bytes AS (SELECT doc_id, run, n, hex(encode(doc_id || ':' || run)) AS x FROM long),
        sums AS (
            SELECT doc_id, run, n, xor(4294967295, list_reduce(list_concat([4294967295], [CAST(concat('0x', substr(x, 2 * k + 1, 2)) AS BIGINT) FOR k IN range(length(x) // 2)]),
                lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h FROM bytes, tab),
        spelt AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, n FROM sums),
        words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cuts AS (SELECT word, n, k, left(word, k) || substr(word, k + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)),
        pairs AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
        near AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
        forms AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
            FROM words LEFT JOIN near USING (word)),
        chain AS (
            SELECT word, word AS root, form AS ahead FROM forms
            UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.ahead)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.ahead IS NULL""",
}
