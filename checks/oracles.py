"""The SQL each query is compared with, for DuckDB over the same tables."""

from __future__ import annotations

from articleloom.functions.lexicon import DEFAULT_DOMAIN, MEDICAL_DOMAINS, Lexicon
from articleloom.operators.context import PROMPT_TEMPLATE
from checks.inputs import LANGUAGE_DEFAULT, LANGUAGE_LEXICON


def clean(text: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), '[\r\n\s\x0B]+', ' ', 'g'))"


def classify(content: str, lexicon: Lexicon = MEDICAL_DOMAINS, default: str = DEFAULT_DOMAIN) -> str:
    branches = []
    for domain, keywords in lexicon:
        hits = " OR ".join(f"contains(lower({content}), '{word.lower()}')" for word in keywords)
        branches.append(f"WHEN {hits} THEN '{domain}'")
    return f"CASE {' '.join(branches)} ELSE '{default}' END"


def term_counts(source: str, key: str, text: str) -> str:
    """Count per text and bucket."""
    return rf"""
        SELECT {key}, CAST(('0x' || substr(md5(token), 1, 8))::BIGINT % 256 AS INTEGER) AS bucket, count(*) AS tf
        FROM (SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+')) AS token FROM {source})
        WHERE token <> ''
        GROUP BY 1, 2"""


EXTRACTED = """
    extracted AS (
        SELECT md5(text) AS pmid,
               'Document ' || doc_id || ' in ' || lang AS article_title,
               source AS journal,
               CASE WHEN n_chars < 100 THEN NULL WHEN n_chars < 200 THEN ''
                    ELSE CAST(1990 + n_chars % 35 AS VARCHAR) END AS year,
               text AS citation_text,
               'doc-' || doc_id AS ref_id, lang, doc_id
        FROM documents),
    gaps AS (
        SELECT * REPLACE (CASE lang WHEN 'de' THEN 'unknown' WHEN 'es' THEN NULL ELSE pmid END AS pmid)
        FROM extracted)"""


def processed(lexicon: Lexicon = MEDICAL_DOMAINS, default: str = DEFAULT_DOMAIN) -> str:
    return f"""{EXTRACTED},
    ranked AS (
        SELECT *, sha256(ref_id || '#' || pmid) AS text_id,
               row_number() OVER (PARTITION BY pmid ORDER BY ref_id) AS place
        FROM extracted
        WHERE length(trim(citation_text)) > 50),
    cleaned AS (
        SELECT *, {clean("citation_text")} AS content FROM ranked WHERE place = 1),
    processed AS (
        SELECT text_id, ref_id, pmid, article_title AS title, journal, year, content,
               {classify("content", lexicon, default)} AS domain,
               CAST(length(content) AS INTEGER) AS text_length
        FROM cleaned)"""


BY_LANGUAGE = processed(LANGUAGE_LEXICON, LANGUAGE_DEFAULT)


def chunked(source: str, extra: str = "") -> str:
    """Chunks of ``source(text_id, content, <extra>)`` by recursion; words are shorter than a chunk."""
    return f"""
    ends AS (
        SELECT text_id, content, length(content) AS size, 1 AS a, 0 AS chunk_ix,
               CASE WHEN length(content) <= 1000 THEN length(content) + 1
                    ELSE 1002 - strpos(reverse(substr(content, 2, 1000)), ' ') END AS b
        FROM {source} WHERE content <> ''
        UNION ALL
        SELECT text_id, content, size, a, chunk_ix,
               CASE WHEN size - a + 1 <= 1000 THEN size + 1
                    ELSE a + 1001 - strpos(reverse(substr(content, a + 1, 1000)), ' ') END
        FROM (
            SELECT text_id, content, size, chunk_ix + 1 AS chunk_ix,
                   start - 1 + strpos(substr(content, start, b - start + 1), ' ') AS a
            FROM (
                SELECT *, greatest(b - 200, a + 1,
                           CASE WHEN strpos(substr(content, b + 1), ' ') = 0 THEN size + 1
                                ELSE b + strpos(substr(content, b + 1), ' ') END - 1000) AS start
                FROM ends WHERE b <= size))),
    pieces AS (
        SELECT text_id, CAST(chunk_ix AS INTEGER) AS chunk_ix, text_id || '#' || chunk_ix AS chunk_id,
               trim(substr(content, a, b - a)) AS page_content
        FROM ends),
    chunks AS (
        SELECT chunk_id, chunk_ix, page_content{extra}
        FROM pieces JOIN {source} USING (text_id))"""


METADATA = """, coalesce(pmid, 'N/A') AS pmid, coalesce(title, 'N/A') AS title,
               coalesce(year, 'N/A') AS year, coalesce(ref_id, 'N/A') AS source"""

CHUNKED = f"WITH RECURSIVE {processed()}, {chunked('processed', METADATA)}"

RAW = """
    raw AS (
        SELECT 'doc-' || doc_id AS ref_id,
               CASE WHEN n_chars < 100 THEN 'unknown' WHEN n_chars < 200 THEN NULL
                    ELSE CAST(doc_id AS VARCHAR) END AS pmid,
               CASE WHEN lang = 'fr' THEN 'unknown' ELSE 'Part ' || doc_id END AS article_title,
               CASE WHEN lang = 'fr' THEN 'unknown' ELSE source END AS journal,
               CASE WHEN n_chars < 100 THEN 'unknown' WHEN n_chars < 200 THEN NULL
                    ELSE CAST(1990 + n_chars % 35 AS VARCHAR) END AS year,
               CASE WHEN lang = 'es' THEN '' ELSE replace(text, chr(10), ' ') END || ' ' ||
               CASE WHEN lang = 'de' THEN '' ELSE text END AS citation_text
        FROM documents)"""


XML_ARTICLES = f"""
    WITH {RAW}
    SELECT pmid, article_title AS title, journal, year, content, {classify("content")} AS domain,
           CAST(length(content) AS INTEGER) AS text_length
    FROM (SELECT *, {clean("citation_text")} AS content FROM raw
          WHERE length(trim(citation_text)) > 50 AND pmid IS NOT NULL AND pmid <> 'unknown')"""


def weights(source: str, key: str, text: str) -> str:
    return f"""
        SELECT {key}, bucket, round(tf / sqrt(sum(tf * tf) OVER (PARTITION BY {key})), 6) AS weight
        FROM ({term_counts(source, key, text)})"""


def knn(metric: str, wanted: str = "q.label % 3 + 4") -> str:
    def total(terms: str) -> str:
        return f"list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda z: {terms}))"

    left, right = "z[1]::DOUBLE", "z[2]::DOUBLE"
    if metric == "l2":
        distance = total(f"({left} - {right}) * ({left} - {right})")
    else:
        norms = f"sqrt({total(f'{left} * {left}')} * {total(f'{right} * {right}')})"
        distance = f"1.0 - coalesce({total(f'{left} * {right}')} / nullif({norms}, 0), 0)"
    return f"""
        SELECT question_id, vec_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) + 0.0 AS distance
        FROM (
            SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, vec_id) AS rank
            FROM (SELECT q.vec_id AS question_id, {wanted} AS top_k, v.vec_id, {distance} AS distance
                  FROM embeddings q, embeddings v))
        WHERE rank <= top_k"""


HITS = f"""{CHUNKED},
    chunk_terms AS ({term_counts("chunks", "chunk_id", "page_content")}),
    question_terms AS ({term_counts("benchmark", "item_id", "text")}),
    chunk_norms AS (SELECT chunk_id, sum(tf * tf)::DOUBLE AS norm FROM chunk_terms GROUP BY 1),
    question_norms AS (SELECT item_id, sum(tf * tf)::DOUBLE AS norm FROM question_terms GROUP BY 1),
    dots AS (
        SELECT item_id, chunk_id, sum(q.tf * c.tf)::DOUBLE AS dot
        FROM question_terms q JOIN chunk_terms c USING (bucket) GROUP BY 1, 2),
    distances AS (
        SELECT item_id AS question_id, text AS question, chunk_id,
               1.0 - coalesce(dot / sqrt(qn.norm * cn.norm), 0) AS distance
        FROM benchmark CROSS JOIN chunks LEFT JOIN dots USING (item_id, chunk_id)
        LEFT JOIN question_norms qn USING (item_id) LEFT JOIN chunk_norms cn USING (chunk_id)),
    hits AS (
        SELECT question_id, question, chunk_id, CAST(place AS INTEGER) AS rank, round(distance, 6) + 0.0 AS distance
        FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, chunk_id) AS place
              FROM distances)
        WHERE place <= 5)"""


def _prompt() -> str:
    before, _, rest = PROMPT_TEMPLATE.partition("{context}")
    between, _, after = rest.partition("{question}")
    literals = ["'" + part.replace("'", "''") + "'" for part in (before, between, after)]
    return f"{literals[0]} || string_agg(page_content, chr(10) || chr(10) ORDER BY rank) || {literals[1]} || question || {literals[2]}"


ORACLES: dict[str, str] = {
    "processed_articles": f"WITH {processed()} SELECT * FROM processed",

    "sample_articles": f"""
        SELECT lang, CASE WHEN n_chars < 100 THEN NULL WHEN n_chars < 200 THEN '10.1/' || doc_id
                    ELSE '10.1/' || doc_id || '|' || doc_id END AS article_ids,
               'Part <i>' || doc_id || '</i>' AS article_title,
               array_to_string([line FOR line IN split(text, chr(10)) IF trim(line) <> ''], '|') AS abstract
        FROM documents WHERE lang = 'de'
        ORDER BY CASE WHEN n_chars < 100 THEN NULL ELSE '10.1/' || doc_id END NULLS FIRST LIMIT 5""",
    "xml_roundtrip_ids": f"WITH {RAW} SELECT pmid, article_title, journal, year FROM raw",
    "xml_articles": XML_ARTICLES,
    "stored_articles": XML_ARTICLES,
    "store_empty_run": XML_ARTICLES,
    "xml_ref_ids": f"WITH {RAW} SELECT lang, pmid FROM raw JOIN documents ON ref_id = 'doc-' || doc_id",
    "xml_inequalities": r"""
        SELECT CAST(doc_id AS VARCHAR) AS pmid,
               trim(regexp_replace(CASE WHEN lang = 'es' THEN '' ELSE replace(text, chr(10), ' ') END
                    || ' p < 0.05 in ' || text || ' and age > 60', '[\r\n\s\x0B]+', ' ', 'g')) AS content
        FROM documents WHERE lang <> 'de' AND n_chars >= 200""",
    "xml_funnel": f"""
        WITH {RAW}, fields AS (SELECT raw.*, lang FROM raw JOIN documents ON ref_id = 'doc-' || doc_id),
        verdicts AS (
            SELECT lang, lang <> 'fr' AND length(trim(citation_text)) > 50 AND coalesce(pmid <> 'unknown', false) AS usable
            FROM fields)
        SELECT count(*) AS initial_count, count(*) FILTER (usable) AS kept_count,
               count(*) FILTER (lang = 'fr') AS malformed_count, count(*) FILTER (NOT usable) AS dropped_count
        FROM verdicts""",
    "processed_times": f"WITH {processed()} SELECT pmid, true AS is_stamped FROM processed",
    "report_job": f"""
        WITH {BY_LANGUAGE}
        SELECT 'overview' AS report, domain AS key,
               count(*) || ' ' || CAST(CAST(round(avg(text_length), 3) AS DECIMAL(20, 3)) AS VARCHAR) AS value
        FROM processed GROUP BY domain
        UNION ALL (
            SELECT 'years', year, CAST(count(*) AS VARCHAR) FROM processed WHERE year <> ''
            GROUP BY year ORDER BY year DESC LIMIT 20)
        UNION ALL SELECT 'sample_titles', domain, arg_min(title, text_id) FROM processed GROUP BY domain
        UNION ALL SELECT 'domain_count', 'french', CAST(count(*) AS VARCHAR) FROM processed WHERE domain = 'french'""",
    "xml_roundtrip_year": f"WITH {RAW} SELECT ref_id, year, pmid FROM raw",
    "partitioned_roundtrip": f"WITH {BY_LANGUAGE} SELECT * REPLACE (nullif(year, '') AS year) FROM processed",
    "parquet_tree": "SELECT doc_id, text, CAST(NULL AS VARCHAR) AS source FROM documents",
    "tree_mixed_schemas": """
        SELECT doc_id,
               CASE WHEN lang = 'es' THEN CAST(to_json([text, source]) AS VARCHAR) WHEN lang <> 'fr' THEN text END AS text,
               CAST(CASE lang WHEN 'de' THEN n_chars / 4 WHEN 'es' THEN n_chars % 1000 ELSE n_chars END AS DOUBLE) AS size,
               CASE WHEN lang IN ('de', 'fr') THEN source END AS source,
               CASE lang WHEN 'fr' THEN CAST(doc_id AS VARCHAR) WHEN 'es' THEN CAST(n_chars > 500 AS VARCHAR) END AS label
        FROM documents""",
    "skipped_files": "SELECT 'broken.parquet' AS file",
    "summary_json_roundtrip": f"WITH {BY_LANGUAGE} SELECT text_id, pmid, title, domain, year, journal FROM processed",
    "output_partition_plan": """
        SELECT count(*) AS row_count,
               CAST(greatest(10, least(200, floor(count(*) / 50000))) AS INTEGER) AS partitions
        FROM lineitem""",
    "union_sources": f"""
        SELECT 'documents' AS origin, doc_id AS key, {clean("text")} AS content, source AS journal, NULL::VARCHAR AS url
        FROM documents
        UNION ALL SELECT 'pages', page_id, {clean("html")}, NULL, url FROM pages
        UNION ALL SELECT 'conversations', conv_id, {clean("text")}, NULL, NULL FROM conversations""",
    "index_incremental_append": f"""
        WITH RECURSIVE {processed()},
        both_sources AS (
            SELECT text_id, content, pmid, title, ref_id FROM processed
            UNION ALL
            SELECT sha256('page#' || page_id), {clean("html")}, CAST(page_id AS VARCHAR), NULL, url FROM pages),
        {chunked("both_sources", ", pmid, coalesce(title, 'N/A') AS title, ref_id AS source")}
        SELECT pmid, title, source, count(*) AS chunk_count, CAST(sum(length(page_content)) AS BIGINT) AS characters
        FROM chunks GROUP BY ALL""",
    "index_changed_articles": f"""
        WITH RECURSIVE {processed()},
        changed AS (
            SELECT * REPLACE (CASE WHEN title LIKE '% in de' THEN 'neu und ' || content ELSE content END AS content)
            FROM processed),
        {chunked("changed", ", pmid")}
        SELECT pmid, chunk_ix, page_content FROM chunks""",
    "index_compacted": f"""
        WITH RECURSIVE {processed()},
        changed AS (
            SELECT * REPLACE (CASE WHEN title LIKE '% in de' THEN 'neu und ' || content ELSE content END AS content)
            FROM processed),
        {chunked("changed", ", pmid")}
        SELECT pmid, chunk_ix, page_content FROM chunks""",
    "index_job": f"{CHUNKED} SELECT pmid, chunk_ix, page_content FROM chunks",
    "corpus_status": f"""
        {CHUNKED} SELECT count(*) AS total_chunks, count(DISTINCT pmid) AS total_articles FROM chunks""",

    "extract_defaults": f"WITH {RAW} SELECT ref_id, pmid, article_title, journal, year FROM raw",
    "abstract_flatten": f"WITH {RAW} SELECT ref_id, citation_text FROM raw",
    "stable_text_id": f"WITH {EXTRACTED} SELECT ref_id, sha256(ref_id || '#' || pmid) AS text_id FROM extracted",
    "clean_pages": f"SELECT page_id, {clean('html')} AS content FROM pages",
    "clean_documents": f"SELECT doc_id, {clean('text')} AS content FROM documents",
    "text_length": f"SELECT page_id, CAST(length({clean('html')}) AS INTEGER) AS text_length FROM pages",
    "classify_default": f"SELECT doc_id, {classify(clean('text'))} AS domain FROM documents",
    "classify_custom_lexicon": f"""
        SELECT doc_id, {classify('content', LANGUAGE_LEXICON, LANGUAGE_DEFAULT)} AS domain
        FROM (SELECT doc_id, {clean('text')} AS content FROM documents)""",
    "classify_large_lexicon": f"""
        WITH entries AS (
            SELECT p_brand AS domain, p_name AS word FROM part
            UNION SELECT 'Letter ' || word[1], word
            FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{6,}}')) AS word FROM benchmark)),
        content AS (SELECT doc_id, lower({clean('text')}) AS folded FROM documents)
        SELECT doc_id, coalesce(min(domain), 'none') AS domain
        FROM content LEFT JOIN entries ON contains(folded, lower(word)) GROUP BY doc_id""",
    "title_from_citation": f"""
        SELECT doc_id, CASE WHEN contains(content, '.') THEN split_part(content, '.', 2) ELSE content END AS title
        FROM (SELECT doc_id, {clean('text')} AS content FROM documents)""",

    "filter_min_length": f"WITH {EXTRACTED} SELECT ref_id FROM extracted WHERE length(trim(citation_text)) > 50",
    "filter_valid_key": f"""
        WITH {EXTRACTED} SELECT ref_id, pmid FROM gaps WHERE pmid IS NOT NULL AND pmid <> 'unknown'""",
    "drop_blank_content": r"""
        SELECT doc_id, content FROM (
            SELECT doc_id, CASE lang WHEN 'de' THEN ' ' || chr(9) || chr(10) WHEN 'es' THEN NULL
                                     ELSE text END AS content
            FROM documents)
        WHERE regexp_matches(content, '\S')""",
    "questions_valid": """
        SELECT conv_id, turn, question FROM (
            SELECT conv_id, turn, CASE role WHEN 'system' THEN '  ' ELSE text END AS question FROM conversations)
        WHERE trim(question) <> ''""",
    "funnel_counts": f"""
        WITH {EXTRACTED}
        SELECT count(*) AS initial_count, count(*) FILTER (usable) AS kept_count,
               count(*) - count(*) FILTER (usable) AS dropped_count
        FROM (SELECT length(trim(citation_text)) > 50 AND pmid IS NOT NULL AND pmid <> 'unknown' AS usable FROM gaps)""",
    "dedup_by_key": f"""
        WITH {EXTRACTED}
        SELECT pmid, ref_id, article_title FROM extracted
        QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY ref_id) = 1""",
    "dedup_stored": f"""
        WITH {EXTRACTED}
        SELECT pmid, ref_id, article_title, citation_text FROM extracted
        QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY ref_id) = 1""",

    "dedup_stored_large": f"""
        WITH {EXTRACTED}
        SELECT pmid, ref_id, article_title, citation_text FROM extracted
        QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY ref_id) = 1""",
    "dedup_incremental": f"""
        WITH {EXTRACTED},
        runs AS (
            SELECT CAST(CASE lang WHEN 'fr' THEN 1 ELSE 0 END AS INTEGER) AS run, pmid, ref_id, article_title FROM extracted)
        SELECT run, pmid, ref_id, article_title FROM runs
        QUALIFY row_number() OVER (PARTITION BY pmid ORDER BY run, ref_id) = 1""",
    "domain_counts": f"WITH {BY_LANGUAGE} SELECT domain, count(*) AS count FROM processed GROUP BY 1",
    "domain_overview": f"""
        WITH {BY_LANGUAGE}
        SELECT domain, count(*) AS document_count, round(avg(text_length), 6) AS avg_length FROM processed GROUP BY 1""",
    "year_counts": f"""
        WITH {processed()}
        SELECT year, count(*) AS count FROM processed WHERE year IS NOT NULL AND year <> ''
        GROUP BY 1 ORDER BY 1 DESC LIMIT 20""",
    "domain_sample_title": f"""
        WITH {BY_LANGUAGE} SELECT domain, arg_min(title, text_id) AS sample_title FROM processed GROUP BY 1""",
    "domain_filter_count": f"""
        WITH {BY_LANGUAGE} SELECT count(*) AS document_count FROM processed WHERE domain = 'french'""",

    "chunk_documents": f"""
        WITH RECURSIVE cleaned AS (
            SELECT CAST(doc_id AS VARCHAR) AS text_id, {clean('text')} AS content FROM documents),
        {chunked('cleaned')}
        SELECT chunk_id, chunk_ix, page_content FROM chunks""",
    "chunk_long_words": f"""
        WITH joined AS (SELECT doc_id, replace({clean('text')}, ' ', '') AS content FROM documents),
        cuts AS (
            SELECT *, unnest(CASE WHEN length(content) < 1000 THEN [0] ELSE range(0, length(content) - 200, 800) END) AS start
            FROM joined WHERE content <> '')
        SELECT doc_id || '#' || start // 800 AS chunk_id, CAST(start // 800 AS INTEGER) AS chunk_ix,
               substr(content, start + 1, 1000) AS page_content
        FROM cuts""",
    "chunk_metadata": f"{CHUNKED} SELECT chunk_id, pmid, title, 'N/A' AS journal, year, source, chunk_ix FROM chunks",
    "chunk_counts": f"{CHUNKED} SELECT pmid, count(*) AS chunk_count FROM chunks GROUP BY 1",
    "chunk_term_vectors": f"{CHUNKED} {weights('chunks', 'chunk_id', 'page_content')}",
    "chunk_projected_vectors": f"""
        {CHUNKED}, counts AS ({term_counts('chunks', 'chunk_id', 'page_content')}),
        signs AS (
            SELECT CAST(bucket AS INTEGER) AS bucket, CAST(position AS INTEGER) AS position,
                   CASE WHEN substr(md5(bucket || '/' || position), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign
            FROM range(256) b(bucket), range(16) p(position))
        SELECT chunk_id, position, CAST(coalesce(value, 0) AS DOUBLE) AS value
        FROM (SELECT chunk_id, CAST(position AS INTEGER) AS position FROM chunks, range(16) p(position))
        LEFT JOIN (SELECT chunk_id, position, sum(tf * sign) AS value FROM counts JOIN signs USING (bucket) GROUP BY 1, 2)
        USING (chunk_id, position)""",
    "question_term_vectors": f"""
        SELECT item_id AS question_id, bucket, weight FROM ({weights('benchmark', 'item_id', 'text')})""",

    "knn_l2": knn("l2"),
    "knn_cosine": knn("cosine"),
    "knn_l2_blocks": knn("l2"),
    "knn_cosine_blocks": knn("cosine"),
    "knn_quantised": knn("l2"),
    "knn_approximate_recall": "SELECT count(*) AS questions, true AS reached FROM embeddings",
    "knn_fifty": knn("l2", "50"),
    "knn_single": """
        WITH means AS (
            SELECT position, avg(value::DOUBLE) AS mean
            FROM (SELECT unnest(embedding) AS value, unnest(range(len(embedding))) AS position FROM embeddings)
            GROUP BY 1),
        centre AS (SELECT list(mean ORDER BY position) AS mean FROM means)
        SELECT vec_id, round(distance, 6) + 0.0 AS distance FROM (
            SELECT vec_id, list_sum(list_transform(list_zip(embedding, mean),
                       lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2]))) AS distance
            FROM embeddings, centre)
        ORDER BY distance, vec_id LIMIT 5""",
    "text_search_topk": f"{HITS} SELECT question_id, chunk_id, rank, distance FROM hits",
    "text_search_postings": f"{HITS} SELECT question_id, chunk_id, rank, distance FROM hits",
    "rag_prompts": f"""
        {HITS} SELECT question_id, {_prompt()} AS prompt FROM hits JOIN chunks USING (chunk_id)
        GROUP BY question_id, question""",
    "reference_snippets": f"""
        {HITS} SELECT question_id, rank, pmid, title,
                      CASE WHEN length(page_content) > 300 THEN substr(page_content, 1, 300) || '...'
                           ELSE page_content END AS content
        FROM hits JOIN chunks USING (chunk_id)""",
    "answered_questions": f"""
        {HITS} SELECT question_id, rank, pmid, title,
                      CASE WHEN length(page_content) > 300 THEN substr(page_content, 1, 300) || '...'
                           ELSE page_content END AS content
        FROM hits JOIN chunks USING (chunk_id)""",
    "reference_labels": f"""
        {HITS} SELECT question_id, rank, '[' || rank || '] PMID: ' || pmid AS label, title
        FROM hits JOIN chunks USING (chunk_id)""",
}
