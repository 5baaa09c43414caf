"""The same results in SQL where SQL can express them.

The others need a library's vocabulary, a model trained on the way or an approximate search; they are tested
against plain versions in ``tests/llm``.
"""

from __future__ import annotations

from articleloom.llm.mixing import POWER, SEED
from articleloom.llm.sharding import MODULUS, MULTIPLIERS, SHARDS, round_keys


def _fraction(text: str) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 12))::BIGINT AS DOUBLE) / 281474976710656.0"


MIXING = f"""
    WITH RECURSIVE sizes AS (
        SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source),
    rates AS (
        SELECT source, sum(bytes) OVER () * pow(bytes, {POWER}) / sum(pow(bytes, {POWER})) OVER () / bytes AS rate FROM sizes),
    terms AS (
        SELECT source, rate, 0 AS k, exp(-rate) AS term, exp(-rate) AS total FROM rates
        UNION ALL
        SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM terms
        WHERE k < rate + 10 * sqrt(rate) + 20),
    drawn AS (
        SELECT doc_id, source, {_fraction(f"'{SEED}/' || doc_id")} AS chance FROM documents),
    counted AS (
        SELECT doc_id, source, rate, count(*) FILTER (total <= chance) AS copies
        FROM drawn JOIN terms USING (source) GROUP BY ALL)
    SELECT doc_id, source, CAST(copy AS INTEGER) AS mix_copy, CAST(copies AS INTEGER) AS mix_copies,
           round(rate, 6) AS mix_rate, {_fraction(f"'{SEED}/order/' || doc_id || '/' || copy")} AS mix_key
    FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted)"""


def _mixed(value: str, key: int) -> str:
    first = f"(xor({value}, {key}) % {MODULUS} * {MULTIPLIERS[0]} % {MODULUS})"
    second = f"(xor({first}, {first} >> 15) % {MODULUS} * {MULTIPLIERS[1]} % {MODULUS})"
    return f"xor({second}, {second} >> 13)"


def _network(source: str, condition: str) -> str:
    """One pass over ``source(number, spot)``: the rounds as nested selects."""
    sql = f"SELECT number, n, a, b, spot // b AS l, spot % b AS r FROM {source} {condition}"
    for left, right in round_keys(20):
        sql = f"SELECT number, n, a, b, (l + {_mixed('r', left)}) % a AS l, r FROM ({sql})"
        sql = f"SELECT number, n, a, b, l, (r + {_mixed('l', right)}) % b AS r FROM ({sql})"
    return f"SELECT number, n, a, b, l * b + r AS spot FROM ({sql})"


SHARDING = f"""
    WITH RECURSIVE crc_table AS (
        SELECT list(list_reduce(range(9), lambda c, i:
                   CASE WHEN i = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, start) ORDER BY start) AS crcs
        FROM range(256) firsts(start)),
    bytes AS (
        SELECT doc_id, text, row_number() OVER () - 1 AS number, hex(encode(text)) AS digits FROM documents),
    summed AS (
        SELECT doc_id, text, number, xor(4294967295, list_reduce(
            list_transform(range(1, length(digits), 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT),
            lambda c, byte: xor(c >> 8, crcs[CAST(xor(c, byte) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT))) AS crc
        FROM bytes, crc_table),
    domains AS (
        SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b
        FROM (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM documents)),
    starts AS (SELECT number, n, a, b, number AS spot FROM bytes, domains),
    walk AS (
        {_network("starts", "")}
        UNION ALL
        {_network("walk", "WHERE spot >= n")})
    SELECT doc_id, CAST(strlen(text) + 8 AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law,
           CAST(spot % {SHARDS} AS INTEGER) AS shard, CAST(spot // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM summed JOIN walk USING (number) WHERE spot < n"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPELLING = f"""
    WITH RECURSIVE crc_table AS (
        SELECT list(list_reduce(range(9), lambda c, i:
                   CASE WHEN i = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, start) ORDER BY start) AS crcs
        FROM range(256) firsts(start)),
    runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
    counted AS (
        SELECT doc_id, run, count(*) AS times, hex(encode(doc_id || ':' || run)) AS digits
        FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
    summed AS (
        SELECT run, times, xor(4294967295, list_reduce(
            list_transform(range(1, length(digits), 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT),
            lambda c, byte: xor(c >> 8, crcs[CAST(xor(c, byte) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT))) AS crc
        FROM counted, crc_table),
    changed AS (
        SELECT times, CASE WHEN crc % 97 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word
        FROM summed),
    words AS (
        SELECT word, CAST(sum(times) AS BIGINT) AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
    gaps AS (
        SELECT word, i, substr(word, 1, i) AS x, substr(word, i + 2) AS y
        FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
    removed AS (SELECT DISTINCT g.word, s.word AS shorter FROM gaps g JOIN words s ON s.word = g.x || g.y),
    near AS (
        SELECT a.word, b.word AS other FROM gaps a JOIN gaps b USING (i, x, y) WHERE a.word <> b.word
        UNION ALL SELECT word, shorter FROM removed
        UNION ALL SELECT shorter, word FROM removed),
    best AS (
        SELECT near.word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n
        FROM near JOIN words ON words.word = other GROUP BY near.word),
    forms AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
               CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
        FROM words LEFT JOIN best USING (word)),
    chain AS (
        SELECT word, word AS root FROM forms
        UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
    roots AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = root WHERE form IS NULL)
    SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM forms JOIN roots USING (word)"""

WARC = """
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
           CASE WHEN holder > page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN holder > page_id THEN holder END AS refers_to
    FROM (SELECT *, CASE WHEN strlen(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS holder
          FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))"""


def _terms(key: str, table: str) -> str:
    pattern = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    return f"SELECT {key}, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{pattern}')) AS term FROM {table}"


SEARCH = f"""
    WITH terms AS ({_terms("doc_id", "documents")}),
    asked AS (SELECT item_id, term, count(*) AS times FROM ({_terms("item_id", "benchmark")}) GROUP BY ALL),
    sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
    totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
    weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM counts, totals GROUP BY term, docs),
    impacts AS (
        SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))) AS impact
        FROM counts JOIN sizes USING (doc_id) JOIN weights USING (term), totals),
    scores AS (
        SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score
        FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 20"""

ORACLES: dict[str, str] = {
    "op1_sharding": SHARDING, "op7_mixing": MIXING, "op11_spelling_variants": SPELLING, "op12_warc": WARC, "op13_lexical_search": SEARCH}
