"""Registered queries of the corpus operators, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, divergence, fingerprints, infill, licenses, minhash, mixing, packing, quality, secrets, substrings, suffixes, urls

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _register(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def _first(out: DataFrame, *names: str) -> DataFrame:
    """The named columns, then the others."""
    return out.select(*names, *[c for c in out.columns if c not in names])


@_register
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.judge(_documents(spark, sf))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_stop", "n_lines", F.array_join("broken", ",").alias("broken"),
    )


def _either(rules: tuple[quality.Rule, ...]) -> str:
    return " OR ".join(r.broken() for r in rules)


_SQL["op6_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS v
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, v) > 1
), covered AS (
  SELECT doc_id, sum(n) AS n FROM (
    SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS n FROM twice
  ) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN ({', '.join(f"'{x}'" for x in quality.STOP_WORDS)})))::BIGINT AS n_stop,
    len(l)::BIGINT AS n_lines
  FROM d LEFT JOIN covered c USING (doc_id)
)
SELECT *, array_to_string(list_filter([{', '.join(f"CASE WHEN {r.broken()} THEN '{r.name}' END" for r in quality.RULES)}],
    lambda x: x IS NOT NULL), ',') AS broken,
  ({_either(quality.BASE_RULES)}) AS base_failed, NOT ({_either(quality.BASE_RULES + quality.RULES)}) AS kept
FROM m
"""


@_register
def op7_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return _first(urls.judge(spark.read.parquet(f"{sf}/pages.parquet")), "page_id", "host", "path", "rule", "verdict")


def _values(rules: list[urls.Rule]) -> str:
    return ", ".join(f"({i}, '{r.name}', '{r.verdict}', '{r.regex}')" for i, r in enumerate(rules))


_SQL["op7_url_filters"] = rf"""
WITH a AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(coalesce(url, ''), '://[^/?#]*(.*)', 1, 's') AS rest
  FROM pages
), sites(host, path, name, verdict) AS (
  VALUES ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'),
    ('www.example.com', '/en/', 'www.example.com/en/', 'allow'), ('net', '/es/', 'net/es/', 'block'), ('net', '/fr/', 'net/fr/', 'block')
), patterns(i, name, verdict, regex) AS (
  VALUES {_values(list(urls.PATTERNS))}
), site AS (
  SELECT page_id, s.name, s.verdict FROM a JOIN sites s
    ON (a.host = s.host OR ends_with(a.host, '.' || s.host)) AND starts_with(a.path, s.path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(s.name) DESC) = 1
), pattern AS (
  SELECT page_id, p.name, p.verdict FROM a JOIN patterns p ON regexp_matches(a.host || a.rest, p.regex)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(p.name) DESC, i) = 1
)
SELECT page_id, host, path, s.name AS rule, CASE WHEN s.name IS NULL THEN p.name END AS pattern,
  coalesce(s.verdict, p.verdict, 'allow') AS verdict
FROM a LEFT JOIN site s USING (page_id) LEFT JOIN pattern p USING (page_id)
"""


@_register
def op9_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    return _first(secrets.report(_documents(spark, sf)), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _scan(place: int, kind: secrets.Kind) -> str:
    p = _quoted(kind.pattern)
    return f"""
  SELECT doc_id, {place} AS place, '{kind.name}' AS kind,
    (list_sum(list_transform(cut[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i-1], lambda x: length(x))), 0))::BIGINT AS s,
    length(hits[i]) AS n
  FROM (
    SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT doc_id, string_split_regex(text, {p}) AS cut, regexp_extract_all(text, {p}) AS hits,
        regexp_extract_all(text, {p}, {kind.group}) AS told
      FROM d WHERE regexp_matches(text, {p}))
  ) WHERE length(told[i]) >= {kind.at_least}"""


_SQL["op9_secret_scans"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_scan(i, k) for i, k in enumerate(secrets.KINDS))}),
g AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in secrets.KINDS)},
    string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, place) AS spans,
    string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, place) FILTER (place < {len(secrets.BASE)}) AS base
  FROM f GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}" for k in secrets.KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


@_register
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    out = mixing.plan(_documents(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("probability", "weight")})


def _raking() -> str:
    steps, last = [], "t0"
    for n in range(mixing.ROUNDS):
        for m in mixing.MARGINS:
            name = f"t{n}_{m}"
            steps.append(f"""{name} AS MATERIALIZED (
  SELECT c.* REPLACE (c.share * g.target / sum(c.share) OVER (PARTITION BY c.{m}) AS share) FROM {last} c JOIN goal_{m} g USING ({m}))""")
            last = name
    return ",\n".join(steps) + f",\nfitted AS (SELECT * FROM {last})"


def _goal(m: str) -> str:
    return f"""goal_{m} AS (
  SELECT {m}, weight / sum(weight) OVER () AS target FROM (
    SELECT {m}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {mixing.TEMPER[m]}) AS weight FROM cells GROUP BY {m}))"""


_SQL["op3_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
    CASE {" ".join(f"WHEN regexp_matches(coalesce(text, ''), {_quoted(p)}) THEN '{n}'" for n, p in mixing.TOPICS)}
      ELSE '{mixing.OTHER_TOPIC}' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS tokens,
    ('0x' || md5('{mixing.SEED}|' || doc_id)[1:8])::BIGINT / 4294967296.0 AS u
  FROM documents
), cells AS (
  SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0
), {", ".join(_goal(m) for m in mixing.MARGINS)},
t0 AS (SELECT *, tokens AS share FROM cells),
{_raking()},
rates AS (
  SELECT source, lang, topic, share * (SELECT sum(tokens) FROM cells) * {mixing.FRACTION} / tokens AS rate FROM fitted
), e AS (
  SELECT d.*, CASE WHEN d.tokens > 0 THEN coalesce(rate, 0) ELSE 0 END AS rate FROM d LEFT JOIN rates USING (source, lang, topic)
)
SELECT doc_id, source, lang, topic, tokens, round(least(rate, 1.0), 6) AS probability, round(greatest(rate, 1.0), 6) AS weight,
  u < least(rate, 1.0) AS sampled
FROM e
"""


def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@_register
def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf), vocabulary())


@_register
def op5_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited(_documents(spark, sf))


@_register
def op8_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    out = licenses.scan(_documents(spark, sf))
    listed = lambda name: F.array_join(F.transform("findings", lambda f: f[name]), ",")
    told = F.array_join(F.transform("findings", lambda f: F.concat_ws(
        ":", f["start"], f["end"], f["license"], f["saved"], F.array_join(f["missing"], " "), F.array_join(f["added"], " "))), "|")
    return out.select(
        "doc_id", "n_blocks", F.size("findings").cast("long").alias("n_found"), listed("license").alias("licenses"), told.alias("findings"))


@_register
def op1_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf))


@_register
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.without_repeats(_documents(spark, sf))


@_register
def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.without_repeats(_documents(spark, sf))


@_register
def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf))


_SHARE = f"1 + ({divergence.WHOLE}::HUGEINT * (%s + {divergence.SMOOTHING})) // (%s + {divergence.SMOOTHING} * v)"
_SQL["op11_source_divergence"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{divergence.UPPER}', '{divergence.LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (
  SELECT doc_id, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT doc_id) >= {divergence.MIN_DF}
), n AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM n WHERE n.lang = d.lang AND n.source = d.source), 0) AS total,
    (SELECT count(*) FROM kept WHERE kept.lang = d.lang) AS v
  FROM (SELECT DISTINCT lang, source FROM d) d
), p AS (
  SELECT g.lang, g.source, term, coalesce(n, 0) AS n, {_SHARE % ("coalesce(n, 0)", "total")} AS p
  FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)
), q AS (
  SELECT lang, term, {_SHARE % ("sum(n)", "(SELECT sum(total) FROM g WHERE g.lang = p.lang)")} AS q
  FROM p JOIN (SELECT DISTINCT lang, v FROM g) USING (lang) GROUP BY lang, term, v
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce((
    SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM f
QUALIFY part = 'pair' OR rank <= {divergence.TOP}
"""


@_register
def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return infill.digests(_documents(spark, sf))


_SQL["op12_fill_in_middle"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('{infill.SALT}' || coalesce(doc_id::VARCHAR, '')) AS told
  FROM documents
), h AS (
  SELECT *, len(units)::BIGINT AS n, {", ".join(f"('0x' || told[{k * 8 + 1}:{k * 8 + 8}])::BIGINT AS h{k + 1}" for k in range(4))} FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '{infill.PREFIX}') OR contains(text, '{infill.SUFFIX}') OR contains(text, '{infill.MIDDLE}')
      OR h3 % 100 >= {infill.RATE} THEN '{infill.PLAIN}' WHEN h4 % 100 < {infill.SPM_RATE} THEN '{infill.SPM}' ELSE '{infill.PSM}' END AS form
  FROM h
), p AS (
  SELECT *, array_to_string(units[:a], '') AS pre, array_to_string(units[a+1:b], '') AS mid, array_to_string(units[b+1:], '') AS suf FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> '{infill.PLAIN}' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> '{infill.PLAIN}' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN '{infill.PLAIN}' THEN text
    WHEN '{infill.PSM}' THEN '{infill.PREFIX}' || pre || '{infill.SUFFIX}' || suf || '{infill.MIDDLE}' || mid
    ELSE '{infill.SUFFIX}' || suf || '{infill.PREFIX}' || pre || '{infill.MIDDLE}' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@_register
def op13_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    tokens = packing.Tokens.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return packing.places(_documents(spark, sf), tokens)
