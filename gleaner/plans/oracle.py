"""The same results as plain SQL for DuckDB, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from gleaner.functions import text as tx
from gleaner.functions import vectors
from gleaner.operators import boundaries, distributional, extract, prompt
from gleaner.plans import catalog

SIZE, OVERLAP = tx.CHUNK_SIZE, tx.CHUNK_OVERLAP
STEP = SIZE - OVERLAP


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda x: x <> '')"


def terms(text: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def sentences(text: str) -> str:
    marked = rf"regexp_replace({text}, '([.!?])\s+', '\1' || chr(30), 'g')"
    return f"list_filter(string_split({marked}, chr(30)), lambda x: trim(x) <> '')"


def cleaned(text: str) -> str:
    return f"regexp_replace({text}, ' ?\\.', '.', 'g')"


def number(text: str, start: int, digits: int) -> str:
    return f"('0x' || substr(md5({text}), {start}, {digits}))::BIGINT"


def key(doc: str, chunk: str) -> str:
    return number(f"{doc} || ':' || {chunk}", 1, 15)


def bucket(term: str) -> str:
    return f"({number(term, 1, 8)} % 1024)"


def share(part: str, whole: str) -> str:
    return (
        f"CASE WHEN len({whole}) > 0 THEN round(len(list_distinct(list_intersect({whole}, {part})))"
        f" / len(list_distinct({whole})), 6) ELSE 0.0 END"
    )


def with_ctes(*parts: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts) + "\n" + select.strip()


DOCS = f"""
docs AS (SELECT doc_id, source, lang, {cleaned('text')} AS text FROM documents)"""

CHUNKS = f"""
split AS (SELECT doc_id, source, lang, {words('text')} AS w FROM docs),
starts AS (
  SELECT *, unnest(range(0, CASE WHEN len(w) = 0 THEN 0
    ELSE greatest(1, ceil((len(w) - {OVERLAP}) / {STEP}.0)::INT) END)) AS chunk_no FROM split),
chunks AS (
  SELECT {key('doc_id', 'chunk_no')} AS key, doc_id, chunk_no::INT AS chunk_no, source, lang,
    array_to_string(w[chunk_no * {STEP} + 1 : chunk_no * {STEP} + {SIZE}], ' ') AS content
  FROM starts)"""

CHUNK_REPORT = f"SELECT doc_id, chunk_no, len({words('content')})::INT AS n_words, md5(content) AS content_md5 FROM chunks"

PACKED = f"""
sent AS (
  SELECT doc_id, unnest({sentences('text')}) AS s,
    generate_subscripts({sentences('text')}, 1) AS i FROM docs),
sw AS (SELECT doc_id, i, {words('s')} AS w FROM sent),
cut AS (
  SELECT doc_id, i, w, unnest(range(0, CASE WHEN len(w) > {SIZE} THEN ceil(len(w) / {OVERLAP}.0)::INT ELSE 1 END)) AS p
  FROM sw WHERE len(w) > 0),
unit AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, p) AS u,
    CASE WHEN len(w) > {SIZE} THEN w[p * {OVERLAP} + 1 : (p + 1) * {OVERLAP}] ELSE w END AS w FROM cut),
upto AS (SELECT doc_id, u, w, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY u)::INT AS c FROM unit),
lists AS (
  SELECT doc_id, list_concat([0], list(c ORDER BY u)) AS c, flatten(list(w ORDER BY u)) AS w FROM upto GROUP BY doc_id),
pack AS (
  SELECT doc_id, 0 AS chunk_no, 0 AS s, len(list_filter(c, lambda x: x <= {SIZE})) - 1 AS e, c, w FROM lists
  UNION ALL
  SELECT doc_id, chunk_no + 1, n, len(list_filter(c, lambda x: x <= c[n + 1] + {SIZE})) - 1, c, w
  FROM (
    SELECT doc_id, chunk_no, c, w,
      len(list_filter(c, lambda x: x < c[e + 1] - least({OVERLAP}, {SIZE} - (c[e + 2] - c[e + 1])))) AS n
    FROM pack WHERE e + 1 < len(c))),
chunks AS (
  SELECT doc_id, chunk_no::INT AS chunk_no, array_to_string(w[c[s + 1] + 1 : c[e + 1]], ' ') AS content FROM pack)"""

MODEL = f"""
tok AS (SELECT key, unnest({terms('content')}) AS t FROM chunks),
tf AS (SELECT key, {bucket('t')} AS b, count(*) AS tf FROM tok GROUP BY ALL),
total AS (SELECT count(*) AS n FROM chunks),
idf AS (SELECT r.b, ln((n + 1) / (coalesce(d.df, 0) + 1.0)) AS idf
  FROM (SELECT unnest(range(1024)) AS b) r LEFT JOIN (SELECT b, count(*) AS df FROM tf GROUP BY b) d USING (b), total)"""


def embedded(name: str, counts: str, id_column: str) -> str:
    """Weights of length one, stored as 32-bit floats, in long form."""
    return f"""
{name}_raw AS (SELECT {id_column}, b, tf * idf AS w FROM {counts} JOIN idf USING (b)),
{name}_len AS (SELECT {id_column}, sqrt(sum(w * w)) AS n FROM {name}_raw GROUP BY ALL),
{name} AS (SELECT {id_column}, b, (w / n)::FLOAT::DOUBLE AS w FROM {name}_raw JOIN {name}_len USING ({id_column})
  WHERE n > 0 AND w <> 0)"""


CORPUS = MODEL + "," + embedded("vec", "tf", "key")

BENCH = "\nasked AS (SELECT item_id AS query_id, text AS question FROM benchmark)"

CHAT = f"""
asked AS (
  SELECT {key('u.conv_id', 'u.turn')} AS query_id, u.text AS question, a.text AS ground_truth,
    CASE WHEN u.turn <= 1 THEN 'first' ELSE 'follow_up' END AS evolution_type,
    NOT EXISTS (SELECT 1 FROM conversations l WHERE l.conv_id = u.conv_id AND l.turn = u.turn + 2) AS episode_done
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

ASKED_VECTORS = f"""
qtok AS (SELECT query_id, unnest({terms('question')}) AS t FROM asked),
qtf AS (SELECT query_id, {bucket('t')} AS b, count(*) AS tf FROM qtok GROUP BY ALL),""" + embedded("qvec", "qtf", "query_id")


def found(k: int, where: str = "true") -> str:
    """The k nearest chunks of every question, over all pairs."""
    return ASKED_VECTORS + f""",
dots AS (SELECT query_id, key, sum(q.w * v.w) AS d FROM qvec q JOIN vec v USING (b) GROUP BY ALL),
qn AS (SELECT query_id, sqrt(sum(w * w)) AS n FROM qvec GROUP BY ALL),
vn AS (SELECT key, sqrt(sum(w * w)) AS n FROM vec GROUP BY ALL),
pairs AS (
  SELECT a.query_id, c.key, round(coalesce(d / (qn.n * vn.n), 0.0), 6) AS score
  FROM asked a CROSS JOIN (SELECT * FROM chunks WHERE {where}) c LEFT JOIN dots USING (query_id, key)
  LEFT JOIN qn USING (query_id) LEFT JOIN vn USING (key)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key)::INT AS rank FROM pairs),
found AS (SELECT query_id, rank, score, key FROM ranked WHERE rank <= {k})"""


CONTEXTS = """
ctx AS (SELECT query_id, list(content ORDER BY rank) AS context FROM found JOIN chunks USING (key) GROUP BY query_id)"""


def answers(source: str = "ctx") -> str:
    """The first context sentence with the most question terms, cut to the answer length."""
    return f"""
texts AS (SELECT query_id, unnest(context) AS content, generate_subscripts(context, 1) AS rank FROM {source}),
sents AS (SELECT query_id, rank, unnest({sentences('content')}) AS s,
  generate_subscripts({sentences('content')}, 1) AS place FROM texts),
hits AS (SELECT query_id, rank, place, s,
  len(list_distinct(list_intersect({terms('question')}, {terms('s')}))) AS n FROM sents JOIN asked USING (query_id)),
picked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, rank, place) AS r FROM hits),
answers AS (SELECT query_id, array_to_string(({words('s')})[1:{tx.ANSWER_TOKENS}], ' ') AS answer FROM picked WHERE r = 1)"""


BASE = (DOCS, CHUNKS)
SEARCHED = (DOCS, CHUNKS, CORPUS, BENCH)
EVALUATED = (DOCS, CHUNKS, CORPUS, CHAT, found(2), CONTEXTS, answers())

TABLE = """
evaluation AS (SELECT query_id, question AS inputs, answer, context, ground_truth, evolution_type, episode_done
  FROM asked LEFT JOIN answers USING (query_id) LEFT JOIN ctx USING (query_id))"""

SIMILARITY = f"""
sided AS (
  SELECT query_id, unnest({terms("coalesce(answer, '')")}) AS t, 1 AS a, 0 AS g FROM evaluation
  UNION ALL SELECT query_id, unnest({terms("coalesce(ground_truth, '')")}), 0, 1 FROM evaluation),
per_term AS (SELECT query_id, t, sum(a) AS a, sum(g) AS g FROM sided GROUP BY ALL),
sums AS (SELECT query_id, sum(a) AS a, sum(g) AS g, sum(least(a, g)) AS shared FROM per_term GROUP BY query_id),
similarity AS (
  SELECT query_id,
    round(CASE WHEN a > 0 THEN shared / a ELSE 0.0 END, 6) AS precision,
    round(CASE WHEN g > 0 THEN shared / g ELSE 0.0 END, 6) AS recall,
    round(CASE WHEN coalesce(a, 0) + coalesce(g, 0) > 0 THEN 2 * shared / (a + g) ELSE 0.0 END, 6) AS f1
  FROM (SELECT query_id, coalesce(a, 0) AS a, coalesce(g, 0) AS g, coalesce(shared, 0) AS shared
    FROM evaluation LEFT JOIN sums USING (query_id)))"""

RELEVANCE = f"""
rel AS (SELECT query_id, {terms('inputs')} AS q, {terms("coalesce(answer, '')")} AS a,
  {terms(r"coalesce(array_to_string(context, chr(10)), '')")} AS c FROM evaluation),
relevance AS (SELECT query_id, {share('a', 'q')} AS answer_relevance, {share('c', 'q')} AS context_relevance FROM rel)"""

SCORED = (*EVALUATED, TABLE, SIMILARITY, RELEVANCE, """
scored AS (SELECT * FROM evaluation JOIN similarity USING (query_id) JOIN relevance USING (query_id))""")

TOTALS = "count(*) AS n_rows, " + ", ".join(
    f"round(avg({m}), 6) AS {m}_mean, round(var_pop({m}), 6) AS {m}_variance, "
    f"round(quantile_cont({m}, 0.9), 6) AS {m}_p90"
    for m in catalog.METRICS
)

BM25 = (*SEARCHED, found(5), f"""
lens AS (SELECT key, {terms('content')} AS d FROM chunks),
size AS (SELECT count(*) AS n, avg(len(d)) AS length FROM lens),
df AS (SELECT t, count(*) AS df FROM (SELECT unnest(list_distinct(d)) AS t FROM lens) GROUP BY t),
cand AS (SELECT query_id, key, rank, unnest(list_distinct({terms('question')})) AS t
  FROM found JOIN asked USING (query_id)),
part AS (
  SELECT c.query_id, c.key, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
    / (tf + 1.2 * (1 - 0.75 + 0.75 * len(d) / length)) AS p
  FROM (SELECT c.query_id, c.key, c.t, len(list_filter(d, lambda x: x = c.t)) AS tf, d FROM cand c JOIN lens USING (key)) c
  JOIN df USING (t), size WHERE tf > 0),
scores AS (SELECT f.query_id, f.key, f.rank, round(coalesce(sum(p), 0.0), 6) AS bm25
  FROM found f LEFT JOIN part USING (query_id, key) GROUP BY ALL),
rescored AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bm25 DESC, key)::INT AS new_rank FROM scores)""")


def html_text() -> str:
    text = f"regexp_replace(html, {quoted(extract.HTML_HIDDEN)}, '', 'g')"
    text = f"regexp_replace({text}, {quoted(extract.HTML_SECTION_END)}, chr(10), 'g')"
    text = f"regexp_replace({text}, {quoted(extract.HTML_TAG)}, '', 'g')"
    for name, character in extract.HTML_REFERENCES:
        text = f"replace({text}, {quoted(name)}, {quoted(character)})"
    return f"list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def template(parts: tuple[str, str, str], context: str, question: str) -> str:
    head, middle, tail = parts
    return f"{quoted(head)} || {context} || {quoted(middle)} || {question} || {quoted(tail)}"


STUFFED = "array_to_string(context, chr(10))"
QUESTION_CONTEXTS = (*SEARCHED, found(2), CONTEXTS)


def whole_vector(sign: str = "") -> str:
    """All dimensions of the vector scaled to length one, in steps of a thousandth."""
    length = "sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))"
    steps = f"list_transform(embedding, lambda x: round(({sign}x::DOUBLE / {length})::FLOAT::DOUBLE * 1000)::BIGINT::VARCHAR)"
    return f"md5(array_to_string({steps}, ',')) AS vector_md5"


INDEX_SAMPLE, TURNED_SAMPLE = whole_vector(), whole_vector("-")


def overlaps(source: str) -> str:
    """Words a chunk shares with the end of the one before, compared word by word."""
    return f"""
cw AS (SELECT doc_id, chunk_no, {words('content')} AS w FROM {source})
SELECT b.doc_id, b.chunk_no, list_max(list_filter(range(0, least(len(a.w), len(b.w)) + 1),
  lambda m: m = 0 OR (b.w[1] = a.w[len(a.w) - m + 1] AND b.w[1 : m] = a.w[len(a.w) - m + 1 : len(a.w)])))::INT AS shared_words
FROM cw a JOIN cw b ON a.doc_id = b.doc_id AND b.chunk_no = a.chunk_no + 1"""


def sign_bits() -> str:
    planes = vectors.sign_planes(64, catalog.SIGN_BITS)
    sides = [f"CASE WHEN list_dot_product(embedding::DOUBLE[], {plane}::DOUBLE[]) >= 0 THEN {1 << b} ELSE 0 END" for b, plane in enumerate(planes)]
    return " + ".join(sides)



def nearest_vectors(join: str) -> str:
    return f"""
WITH pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS key,
    round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
  FROM embeddings q JOIN embeddings c ON {join}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key)::INT AS rank FROM pairs)
SELECT query_id, rank, score, key FROM ranked WHERE rank <= 5"""


SHORTENED = with_ctes(
    f"docs AS (SELECT doc_id, source, lang, CASE lang WHEN 'fr' THEN array_to_string(({words(cleaned('text'))})[1:100], ' ') "
    f"WHEN 'de' THEN '' ELSE {cleaned('text')} END AS text FROM documents)",
    CHUNKS,
    select="SELECT key, doc_id, chunk_no, md5(content) AS content_md5 FROM chunks",
)

VERSIONS = """
WITH v1 AS (SELECT doc_id, text, source FROM documents),
alive AS (SELECT * FROM v1 WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
v2 AS (SELECT doc_id, CASE WHEN source IN ('src1', 'src3') THEN substr(text, 1, 100) ELSE text END AS text, source FROM alive),
v3 AS (
  SELECT v2.doc_id, CASE WHEN v2.source = 'src3' THEN v1.text ELSE v2.text END AS text,
    CASE v2.source WHEN 'src2' THEN 'src2b' ELSE v2.source END AS source FROM v2 JOIN v1 USING (doc_id)
  UNION ALL SELECT -1 - page_id, html, 'web' FROM pages)
"""


def steps(old: str, new: str) -> str:
    """The row changes between two tables of (doc_id, text, source)."""
    other = f"SELECT doc_id FROM {old} JOIN {new} USING (doc_id) WHERE {old}.text <> {new}.text OR {old}.source <> {new}.source"
    return (
        f"SELECT doc_id, 'insert' AS change, source, md5(text) AS text_md5 FROM {new} WHERE doc_id NOT IN (SELECT doc_id FROM {old}) "
        f"UNION ALL SELECT doc_id, 'delete', source, md5(text) FROM {old} WHERE doc_id NOT IN (SELECT doc_id FROM {new}) "
        f"UNION ALL SELECT doc_id, 'update_pre', source, md5(text) FROM {old} WHERE doc_id IN ({other}) "
        f"UNION ALL SELECT doc_id, 'update_post', source, md5(text) FROM {new} WHERE doc_id IN ({other})"
    )


TYPES = f"""
typed AS (
  SELECT lower(regexp_replace(regexp_replace(unnest({words('text')}), '{boundaries.OPENERS.replace("'", "''")}', ''), '{boundaries.CLOSERS.replace("'", "''")}', '')) AS t FROM docs),
bases AS (SELECT regexp_replace(t, '\\.$', '') AS base, t LIKE '%.' AS dot FROM typed),
dots AS (SELECT base, count_if(dot) AS n_dot, count_if(NOT dot) AS n_plain FROM bases GROUP BY base),
counted AS (
  SELECT base, n_dot::BIGINT AS n_dot, n_plain::BIGINT AS n_plain FROM dots WHERE regexp_matches(base, '^\\p{{L}}+(\\.\\p{{L}}+)*$')
  UNION ALL SELECT '', coalesce(sum(n_dot), 0)::BIGINT, coalesce(sum(n_plain), 0)::BIGINT FROM dots),
total AS (SELECT (n_dot + n_plain)::DOUBLE AS n, n_dot::DOUBLE AS d FROM counted WHERE base = ''),
scored AS (
  SELECT c.*, round(-2 * (n_dot * ln(d / n) + n_plain * ln(1 - d / n) - n_dot * ln(0.99) - n_plain * ln(1 - 0.99))
      * exp(-length(replace(base, '.', ''))) * (length(base) - length(replace(base, '.', '')) + 1)
      * pow(length(replace(base, '.', '')), -n_plain), 6) AS score
  FROM counted c, total WHERE base <> '' AND n_dot >= {boundaries.LEAST_COUNT}),
abbreviated AS (SELECT * FROM scored WHERE score >= {boundaries.LEAST_SCORE})"""


PAIRS = f"""
t AS (SELECT row_number() OVER () AS row, {terms('text')} AS terms FROM docs),
vocabulary AS (
  SELECT term FROM (SELECT unnest(list_distinct(terms)) AS term FROM t) GROUP BY term HAVING count(*) >= {distributional.LEAST_DOCUMENTS}
  ORDER BY count(*) DESC, term LIMIT {distributional.VOCABULARY}),
placed AS (SELECT row, unnest(terms) AS term, generate_subscripts(terms, 1) AS i FROM t),
known AS (SELECT * FROM placed SEMI JOIN vocabulary USING (term)),
apart AS (SELECT x.term AS term_a, y.term AS term_b FROM known x, range(1, {distributional.WINDOW + 1}) AS d(k), known y WHERE y.row = x.row AND y.i = x.i + k),
counted AS (SELECT term_a, term_b, count(*) AS n FROM (SELECT * FROM apart UNION ALL SELECT term_b, term_a FROM apart) GROUP BY ALL),
sums AS (SELECT term_a AS term, sum(n) AS s FROM counted GROUP BY term_a),
matrix AS (
  SELECT term_a, term_b, n, round(ln(n * (SELECT sum(n) FROM counted)::DOUBLE / (a.s::DOUBLE * b.s::DOUBLE)), {distributional.PLACES}) AS value
  FROM counted JOIN sums a ON a.term = term_a JOIN sums b ON b.term = term_b WHERE n >= {distributional.LEAST_PAIRS})"""


def oracle_sql() -> dict[str, str]:
    chunked = with_ctes(*BASE, select=CHUNK_REPORT)
    budget = catalog.STUFF_BUDGET
    history = catalog.HISTORY_BUDGET
    return {
        "A1_scan_files": (
            "SELECT parse_filename(filename) AS file, size::BIGINT AS n_bytes, md5(content) AS content_md5 "
            "FROM read_blob('/root/testdata/sf0.01/*.parquet')"
        ),
        "A1_file_stream": (
            "SELECT parse_filename(filename) AS file, size::BIGINT AS n_bytes, sha256(content) AS sha256, 1::BIGINT AS n_loads "
            "FROM read_blob('/root/testdata/sf0.01/*.parquet')"
        ),
        "A2_save_table": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
        "A3_read_table": "SELECT lang, count(*) AS n_docs, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY lang",
        "A4_create_table": with_ctes(
            *BASE, select="SELECT key AS id, source AS pdf_name, md5(content) AS content_md5, 1024 AS width FROM chunks"
        ),
        "A5_append_rows": with_ctes(
            *BASE,
            select="SELECT (2 * count(*))::BIGINT AS n_rows, count(DISTINCT key) AS n_ids, 2::BIGINT AS most_copies FROM chunks",
        ),
        "A6_csv_round_trip": with_ctes(
            CHAT,
            select="SELECT query_id, md5(question) AS question_md5, md5(ground_truth) AS truth_md5, "
            "evolution_type, episode_done FROM asked",
        ),
        "A7_zip_columns": with_ctes(
            DOCS,
            f"sent AS (SELECT doc_id, unnest({sentences('text')}) AS s, "
            f"generate_subscripts({sentences('text')}, 1) AS i FROM docs)",
            select=f"SELECT doc_id, (i - 1)::INT AS place, md5(s) AS sentence_md5, len({words('s')})::INT AS n_tokens FROM sent",
        ),
        "A8_named_file": f"""
SELECT url AS path, octet_length(encode(html))::BIGINT AS n_bytes,
  md5(array_to_string(list_transform({html_text()}, lambda s: {cleaned('s')}), chr(10))) AS text_md5
FROM pages WHERE url = (SELECT min(url) FROM pages)""",
        "A9_manifest": """
SELECT doc_id, 'missing' AS status FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'extra' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
        "B1_extract_text": f"""
SELECT page_id, len(s)::INT AS n_sections, md5(array_to_string(s, chr(10))) AS text_md5
FROM (SELECT page_id, {html_text()} AS s FROM pages)""",
        "B2_clean_section": f"""
SELECT doc_id, md5({cleaned("replace(text, chr(10), '')")}) AS joined_md5,
  md5({cleaned("replace(text, chr(10), ' ')")}) AS spaced_md5 FROM documents""",
        "B3_join_sections": f"SELECT doc_id, md5({cleaned('text')}) AS text_md5 FROM documents",
        "B4_core_lines": f"""
WITH lines AS (
  SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
core AS (SELECT * FROM lines
  WHERE len({words('line')}) >= {extract.CORE_MIN_WORDS} AND NOT regexp_matches(line, {quoted(extract.CONTENTS_LINE)})),
common AS (SELECT line FROM core GROUP BY line HAVING count(DISTINCT doc_id) > {catalog.CORE_MAX_SHARE} * (SELECT count(*) FROM documents)),
kept AS (SELECT * FROM core WHERE line NOT IN (SELECT line FROM common)),
docs AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::INT AS n_lines, md5(coalesce(t, '')) AS lines_md5 FROM documents LEFT JOIN docs USING (doc_id)""",
        "C1_sentences": with_ctes(
            DOCS,
            select=f"SELECT doc_id, (generate_subscripts({sentences('text')}, 1) - 1)::INT AS sentence_no, "
            f"md5(unnest({sentences('text')})) AS sentence_md5 FROM docs",
        ),
        "C1_dot_counts": with_ctes(DOCS, TYPES, select="SELECT * FROM counted"),
        "C1_abbreviations": with_ctes(DOCS, TYPES, select="SELECT * FROM abbreviated"),
        "C2_token_count": with_ctes(
            DOCS,
            select=f"SELECT doc_id, len({words('text')})::INT AS n_tokens, len({words('text')}) <= {SIZE} AS one_chunk FROM docs",
        ),
        "C3_window_chunks": chunked,
        "C4_packed_chunks": with_ctes(DOCS, PACKED, select=CHUNK_REPORT),
        "C5_chunk_rows": with_ctes(*BASE, select="SELECT key, doc_id, chunk_no FROM chunks"),
        "C6_project": with_ctes(*BASE, select="SELECT source AS pdf_name, md5(content) AS content_md5 FROM chunks"),
        "C7_neighbour_overlap": "WITH RECURSIVE " + ",".join([*BASE, overlaps("chunks")]),
        "C7_packed_overlap": "WITH RECURSIVE " + ",".join([DOCS, PACKED, overlaps("chunks")]),
        "C8_context_fit": with_ctes(
            *BASE,
            select=f"""
SELECT doc_id, count(c.doc_id)::INT AS n_chunks, count(*) FILTER (n > {catalog.FIT_LIMIT})::INT AS n_too_long,
  coalesce(max(n), 0)::INT AS longest
FROM documents LEFT JOIN (SELECT doc_id, len({words('content')}) AS n FROM chunks) c USING (doc_id) GROUP BY doc_id""",
        ),
        "C9_python_chunks": chunked,
        "D1_term_counts": with_ctes(*BASE, MODEL, select="SELECT key, b::INT AS bucket, tf FROM tf"),
        "D1_embedding": with_ctes(
            *BASE, CORPUS, select="SELECT key, b::INT AS bucket, round(w, 4) AS weight FROM vec"
        ),
        "D2_request_groups": """
WITH placed AS (SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 150 AS b FROM documents)
SELECT source, b::BIGINT AS batch_no, count(*) AS n_texts, min(doc_id) AS first_id, max(doc_id) AS last_id
FROM placed GROUP BY source, b""",
        "D3_embed_question": with_ctes(
            *BASE, MODEL, BENCH, ASKED_VECTORS,
            select="SELECT query_id, b::INT AS bucket, round(w, 4) AS weight FROM qvec",
        ),
        "D4_check_width": """
SELECT vec_id, len(embedding)::INT AS width, true AS accepted FROM embeddings
UNION ALL SELECT vec_id, len(embedding[1:20])::INT, false FROM embeddings""",
        "D5_preview": """
SELECT vec_id, (generate_subscripts(embedding[1:20], 1) - 1)::INT AS place,
  round(unnest(embedding[1:20])::DOUBLE, 6) AS value FROM embeddings""",
        "D6_model_check": with_ctes(*SEARCHED, found(1), select="SELECT * FROM found"),
        "E1_index_vectors": f"SELECT vec_id, label, {INDEX_SAMPLE} FROM embeddings",
        "E2_index_text": with_ctes(*SEARCHED, found(4), select="SELECT * FROM found"),
        "E3_create_or_sync": """
SELECT s::INT AS step, count(*) FILTER (s < 4 OR label <> 0) AS n_rows, count(*) FILTER (s < 4 OR label <> 0) AS n_keys,
  count(*) FILTER (s >= 2 AND label = 3) + count(*) FILTER (s = 4 AND label = 0) AS n_changes
FROM embeddings, range(5) t(s) GROUP BY s""",
        "E4_sync_stream": with_ctes(
            *BASE, select="SELECT key, doc_id, chunk_no, md5(content) AS content_md5, 1024 AS width FROM chunks"
        ),
        "E4_keyed_state": SHORTENED,
        "E4_changed_documents": SHORTENED,
        "E5_version_feed": VERSIONS + "SELECT 1 AS version, doc_id, 'insert' AS change, source, md5(text) AS text_md5 FROM v1"
        + "".join(f" UNION ALL SELECT {i + 1}, * FROM ({steps(f'v{i}', f'v{i + 1}')})" for i in (1, 2)),
        "E5_net_feed": VERSIONS + steps("v1", "v3"),
        "E5_change_feed": f"""
WITH old AS (SELECT doc_id, text, source FROM documents),
new AS (
  SELECT doc_id, {cleaned("replace(text, chr(10), '')")} AS text, source FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT -1 - page_id, html, 'web' FROM pages),
changed AS (SELECT doc_id FROM old JOIN new USING (doc_id) WHERE old.text <> new.text OR old.source <> new.source)
SELECT doc_id, 'insert' AS change, source, md5(text) AS text_md5 FROM new WHERE doc_id NOT IN (SELECT doc_id FROM old)
UNION ALL SELECT doc_id, 'delete', source, md5(text) FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new)
UNION ALL SELECT doc_id, 'update_pre', source, md5(text) FROM old WHERE doc_id IN (SELECT doc_id FROM changed)
UNION ALL SELECT doc_id, 'update_post', source, md5(text) FROM new WHERE doc_id IN (SELECT doc_id FROM changed)""",
        "E6_continuous": f"SELECT vec_id, label, {TURNED_SAMPLE} FROM embeddings",
        "D1_cooccurrence": with_ctes(DOCS, PAIRS, select="SELECT * FROM matrix WHERE value > 0"),
        "E9_index_completeness": """
SELECT count_if(have AND label <> 5)::BIGINT AS indexed, count_if(NOT have AND label <> 5)::BIGINT AS pending, count_if(have AND label = 5)::BIGINT AS orphan,
  count_if(have = (label = 5)) = 0 AS complete
FROM (SELECT vec_id, label, label <> 4 AND (label <> 3 OR vec_id % 2 = 0) AS have FROM embeddings)""",
        "E7_upsert_delete": f"""
SELECT vec_id, label, {INDEX_SAMPLE} FROM embeddings WHERE label NOT IN (0, 1)
UNION ALL SELECT vec_id, label, {TURNED_SAMPLE} FROM embeddings WHERE label = 1""",
        "E8_one_per_key": """
SELECT md5(text) AS text_key, doc_id, lang, source
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id DESC) AS r FROM documents) WHERE r = 1""",
        "E8_repeated_keys": "SELECT md5(text) AS text_key, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1",
        "E9_completeness": """
WITH c AS (
  SELECT count(*) FILTER (d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS indexed,
    count(*) FILTER (l.doc_id IS NULL) AS pending, count(*) FILTER (d.doc_id IS NULL) AS orphan
  FROM documents d FULL JOIN labels l USING (doc_id))
SELECT *, pending = 0 AND orphan = 0 AS complete FROM c""",
        "F1_nearest_vectors": nearest_vectors("true"),
        "F5_all_buckets": nearest_vectors("true"),
        "F5_recall_held": """
WITH pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS key, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
  FROM embeddings q JOIN embeddings c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key) AS rank FROM pairs)
SELECT query_id, string_agg(key::VARCHAR, ',' ORDER BY rank) AS true_keys, true AS buckets_held, true AS tables_held
FROM ranked WHERE rank <= 5 GROUP BY query_id""",
        "F5_sign_buckets": f"""
WITH placed AS (SELECT vec_id, embedding, {sign_bits()} AS bucket FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS key,
    round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS score
  FROM placed q JOIN placed c ON bit_count(xor(q.bucket, c.bucket)) <= 3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key)::INT AS rank FROM pairs)
SELECT query_id, rank, score, key FROM ranked WHERE rank <= 5""",
        "F2_nearest_text": with_ctes(
            *SEARCHED, found(4),
            select="SELECT query_id, rank, score, key, doc_id, chunk_no FROM found JOIN chunks USING (key)",
        ),
        "F3_retriever": with_ctes(
            *SEARCHED, found(2),
            select="SELECT query_id, rank, score, md5(content) AS content_md5 FROM found JOIN chunks USING (key)",
        ),
        "F4_filtered": nearest_vectors("q.label = c.label"),
        "F4_index_filtered": with_ctes(*SEARCHED, found(4, "lang <> 'en'"), select="SELECT * FROM found"),
        "F4_filtered_text": with_ctes(*SEARCHED, found(4, "lang <> 'en'"), select="SELECT * FROM found"),
        "F6_asked_columns": with_ctes(
            *SEARCHED, found(5),
            select="SELECT query_id, rank, source AS pdf_name, md5(content) AS content_md5 FROM found JOIN chunks USING (key)",
        ),
        "F7_passages": with_ctes(
            *SEARCHED, found(5),
            select="SELECT query_id, count(*)::INT AS n_passages, "
            "md5(string_agg(source || '|' || content, chr(10) ORDER BY rank)) AS passages_md5 "
            "FROM found JOIN chunks USING (key) GROUP BY query_id",
        ),
        "F8_question_set": with_ctes(
            DOCS, CHUNKS, CORPUS,
            f"asked AS (SELECT {key('conv_id', 'turn')} AS query_id, text AS question FROM conversations WHERE role = 'user')",
            found(2),
            select="SELECT * FROM found",
        ),
        "F9_contexts": with_ctes(
            *SEARCHED, found(4), CONTEXTS,
            select=f"SELECT query_id, len(context)::INT AS n_texts, md5({STUFFED}) AS context_md5 FROM ctx",
        ),
        "G1_rerank": with_ctes(*BM25, select="SELECT query_id, key, bm25, new_rank FROM rescored"),
        "G2_keep_top": with_ctes(*BM25, select="SELECT query_id, new_rank, key FROM rescored WHERE new_rank <= 3"),
        "G3_order_changes": with_ctes(
            *BM25,
            select="SELECT query_id, key, rank, new_rank, rank - new_rank AS rank_delta, "
            "max(abs(rank - new_rank)) OVER (PARTITION BY query_id) > 0 AS query_changed FROM rescored",
        ),
        "H1_stuffed_context": with_ctes(
            *QUESTION_CONTEXTS,
            f"sized AS (SELECT query_id, context, list_transform(context, lambda c: len({words('c')})) AS n FROM ctx)",
            select=f"""
SELECT query_id, md5({STUFFED}) AS all_md5, md5(array_to_string(
  context[1 : len(list_filter(range(1, len(n) + 1), lambda i: list_sum(n[1:i]) <= {budget}))], chr(10))) AS budget_md5
FROM sized""",
        ),
        "H2_filled_template": with_ctes(
            *QUESTION_CONTEXTS,
            select=f"""
SELECT query_id, md5({template(prompt.TAGGED, STUFFED, 'question')}) AS tagged_md5,
  md5({template(prompt.UNTAGGED, STUFFED, 'question')}) AS untagged_md5 FROM ctx JOIN asked USING (query_id)""",
        ),
        "H3_answer": with_ctes(*QUESTION_CONTEXTS, answers(), select="SELECT query_id, answer FROM answers"),
        "H4_decline": with_ctes(
            *QUESTION_CONTEXTS, answers(),
            select=f"""
SELECT query_id, best_score, CASE WHEN best_score IS NULL OR best_score < {catalog.ANSWER_THRESHOLD}
  THEN {quoted(prompt.REFUSAL)} ELSE answer END AS answer
FROM asked LEFT JOIN (SELECT query_id, max(score) AS best_score FROM found GROUP BY query_id) USING (query_id)
LEFT JOIN answers USING (query_id)""",
        ),
        "H5_chat_prompts": f"""
SELECT u.conv_id, u.turn, md5(coalesce(s.text, {quoted(prompt.NO_SYSTEM)}) || chr(10) || chr(10) || coalesce(a.text, '')
  || chr(10) || chr(10) || 'User: ' || u.text || chr(10) || chr(10) || 'Assistant:') AS prompt_md5
FROM conversations u
LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn - 1 AND a.role = 'assistant'
LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE role = 'system' GROUP BY conv_id) s
  ON s.conv_id = u.conv_id
WHERE u.role = 'user'""",
        "H6_side_by_side": with_ctes(
            *QUESTION_CONTEXTS, answers(),
            select=f"""
SELECT query_id, answer AS best_sentence,
  array_to_string(({words(f"({sentences('context[1]')})[1]")})[1:{tx.ANSWER_TOKENS}], ' ') AS lead_sentence
FROM answers JOIN ctx USING (query_id)""",
        ),
        "H7_chat_history": """
SELECT t.conv_id, t.turn, h.turn AS earlier_turn, h.role, md5(h.text) AS text_md5
FROM conversations t JOIN conversations h ON h.conv_id = t.conv_id AND h.turn < t.turn""",
        "H7_history_budget": f"""
WITH sized AS (SELECT *, greatest(len({words('text')}), 1) AS n FROM conversations),
upto AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) - n AS before FROM sized),
joined AS (
  SELECT t.conv_id, t.turn, h.turn AS h, h.n, h.role || ': ' || h.text AS line
  FROM upto t LEFT JOIN upto h ON h.conv_id = t.conv_id AND h.turn < t.turn AND t.before - h.before <= {history})
SELECT conv_id, turn, count(h) AS n_history, coalesce(sum(n), 0)::BIGINT AS history_tokens,
  md5(coalesce(string_agg(line, chr(10) ORDER BY h) FILTER (h IS NOT NULL), '')) AS history_md5
FROM joined GROUP BY conv_id, turn""",
        "H8_grounding": with_ctes(
            *EVALUATED,
            f"told AS (SELECT query_id, answer, ground_truth, {terms(STUFFED)} AS c "
            "FROM asked JOIN ctx USING (query_id) JOIN answers USING (query_id))",
            f"counted AS (SELECT query_id, {share('c', terms('answer'))} AS supported_share, "
            f"len(list_filter({sentences('answer')}, lambda s: len(list_filter({terms('s')}, lambda t: NOT list_contains(c, t))) > 0))::INT AS n_unsupported, "
            f"{share('c', terms('ground_truth'))} AS share_without, "
            f"len(list_filter({sentences('ground_truth')}, lambda s: len(list_filter({terms('s')}, lambda t: NOT list_contains(c, t))) > 0))::INT AS n_without FROM told)",
            select="SELECT *, round(supported_share - share_without, 6) AS share_gain FROM counted",
        ),
        "I1_evaluation_table": with_ctes(
            *EVALUATED, TABLE,
            select=f"SELECT query_id, md5(inputs) AS inputs_md5, answer, md5({STUFFED}) AS context_md5, "
            "md5(ground_truth) AS truth_md5, evolution_type, episode_done FROM evaluation",
        ),
        "I2_answer_similarity": with_ctes(*EVALUATED, TABLE, SIMILARITY, select="SELECT * FROM similarity"),
        "I2_vector_similarity": with_ctes(
            *EVALUATED, TABLE,
            f"atf AS (SELECT query_id, {bucket('t')} AS b, count(*) AS tf FROM "
            f"(SELECT query_id, unnest({terms('answer')}) AS t FROM evaluation) GROUP BY ALL)",
            embedded("avec", "atf", "query_id"),
            f"gtf AS (SELECT query_id, {bucket('t')} AS b, count(*) AS tf FROM "
            f"(SELECT query_id, unnest({terms('ground_truth')}) AS t FROM evaluation) GROUP BY ALL)",
            embedded("gvec", "gtf", "query_id"),
            "sims AS (SELECT a.query_id, sum(a.w * g.w) AS s FROM avec a JOIN gvec g USING (query_id, b) GROUP BY ALL)",
            select="SELECT query_id, round(coalesce(s, 0.0), 4) AS similarity FROM evaluation LEFT JOIN sims USING (query_id)",
        ),
        "I3_relevance": with_ctes(*EVALUATED, TABLE, RELEVANCE, select="SELECT * FROM relevance"),
        "I4_totals": with_ctes(*SCORED, select=f"SELECT {TOTALS} FROM scored"),
        "I4_scored_rows": with_ctes(
            *SCORED, select="SELECT query_id, precision, recall, f1, answer_relevance, context_relevance FROM scored"
        ),
        "I5_slices": with_ctes(
            *SCORED,
            select=f"SELECT coalesce(evolution_type, 'all') AS evolution_type, {TOTALS} FROM scored GROUP BY ROLLUP (evolution_type)",
        ),
        "J1_name_bucket": """
SELECT c_custkey, c_name, (list_sum(list_transform(string_split(c_name, ''), lambda c: unicode(c))) % 9 + 1)::INT AS bucket
FROM customer""",
    }
