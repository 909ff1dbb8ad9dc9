"""DuckDB SQL for the queries of ``queries``, built from small SQL text functions.

DuckDB's patterns are RE2: no look-around, ``\\s`` of ASCII only, ``(?i)`` of all letters.
"""

from __future__ import annotations

from ..functions import fixed
from .queries import CORE, NFD, NOISE, SAMPLES, TOPICS, taxonomy_rows


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def replace_all(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def tones(x: str) -> str:
    for old, new in fixed.TONES:
        x = f"replace({x}, '{old}', '{new}')"
    return x


def typography(x: str) -> str:
    letter = "a-zA-ZÀ-ỹ"
    x = f"replace(translate({x}, {lit(fixed.TYPOGRAPHY_FROM + fixed.TYPOGRAPHY_REMOVED)}, {lit(fixed.TYPOGRAPHY_TO)}), '…', '...')"
    x = replace_all(x, r"\s+([,.:;?!%])", r"\1")
    x = replace_all(x, f"([{letter}])([,;:])([{letter}])", r"\1\2 \3")
    x = replace_all(x, rf"([{letter}]{{2,}})\.([A-ZÀ-ỹ][a-zÀ-ỹ])", r"\1. \2")
    x = replace_all(x, "([.,:;?!])([\"'])", r"\1 \2")
    x = replace_all(x, r"[^\S\r\n]+", " ")
    x = replace_all(x, r"(?m)^[ \r]+|[ \r]+$", "")
    return f"trim({replace_all(x, chr(92) + 'n{3,}', chr(10) * 2)}, ' ' || chr(13) || chr(10))"


def normalize(x: str) -> str:
    return typography(tones(f"nfc_normalize({x})"))


def boilerplate(x: str) -> str:
    clean = strip("l")
    for pattern, cased in fixed.INLINE_NOISE:
        clean = replace_all(clean, ("" if cased else "(?i)") + pattern, "")
    clean = strip(replace_all(clean, r"\s{2,}", " "))
    any_of = "(?i)" + "|".join(f"(?:{p})" for p in fixed.BOILERPLATE)
    lines = f"list_transform(string_split({x}, chr(10)), lambda l: CASE WHEN {strip('l')} = '' THEN '' ELSE nullif({clean}, '') END)"
    kept = f"list_filter({lines}, lambda y: y IS NOT NULL AND NOT regexp_matches(y, {lit(any_of)}))"
    return strip(replace_all(f"array_to_string({kept}, chr(10))", r"\n{3,}", "\n\n"))


def ratio(x: str) -> str:
    letters = f"length({replace_all(x, '[^' + chr(92) + 'p{L}]', '')})"
    marked = f"length({replace_all(x, '[^' + fixed.DIACRITICS + ']', '')})"
    return f"(CASE WHEN {letters} > 0 THEN {marked}::DOUBLE / {letters} ELSE 0.0::DOUBLE END)"


def score(x: str, r: str) -> str:
    n = f"length({strip(x)})"
    has_list = " OR ".join(f"contains({x}, chr(10) || '{m}')" for m in ("- ", "* ", "1. ", "|"))
    d = lambda v: f"{v}::DOUBLE"
    point = lambda c: f"CASE WHEN {c} THEN {d(0.1)} ELSE {d(0.0)} END"
    structure = f"({d(0.1)} + {point(f'contains({x}, {lit(chr(35))})')} + {point(has_list)} + {point(f'len(string_split({x}, chr(10) || chr(10))) >= 3')})"
    language = f"CASE WHEN {r} >= 0.08 THEN {d(0.3)} WHEN {r} >= 0.03 THEN {d(0.2)} ELSE {d(0.05)} END"
    return f"(CASE WHEN {n} < 50 THEN 0.0::DOUBLE ELSE floor((least({d(0.3)}, {n}::DOUBLE / 1000 * {d(0.3)}) + ({language}) + {structure}) * 1000 + 0.5::DOUBLE) / 1000 END)"


def gate(x: str, r: str) -> str:
    return f"(length({strip(x)}) >= 50 AND ({r} >= 0.03 OR length({strip(x)}) > 200))"


def n_words(x: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> ''))::INTEGER"


def plain(x: str) -> str:
    return f"array_to_string(list_transform(list_filter(string_split({x}, chr(10)), lambda l: {strip('l')} <> ''), lambda l: trim(l, '#* -|>')), ' ')"


def hits(x: str, words: list[str]) -> str:
    return "(" + " + ".join(f"contains({x}, {lit(w)})::INTEGER" for w in words) + ")"


def shingle_list(x: str) -> str:
    w = rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+')"
    runs = f"list_transform(range(1, greatest(len(w) - 1, 2)), lambda i: array_to_string(w[i:i + 2], ' '))"
    return f"(SELECT CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE list_sort(list_distinct({runs})) END FROM (SELECT {w} AS w))"


BRONZE = "SELECT doc_id AS ord, 'doc:' || doc_id AS raw_id, 'html_article' AS source_type, source AS title, source AS category, coalesce(text, '') || {noise} AS raw_content FROM documents"
HEADED = "SELECT doc_id, '# ' || source || chr(10) || '## ' || lang || chr(10) || replace(coalesce(text, ''), '.' || chr(10), '.' || chr(10) || '### part' || chr(10)) AS markdown FROM documents"


def flagged(noise: str) -> str:
    """Bronze with markdown, ratio, score and low_quality."""
    m = normalize(boilerplate("raw_content"))
    return f"""SELECT *, {score('markdown', 'r')} AS quality_score, ({strip('raw_content')} = '' OR NOT {gate('markdown', 'r')}) AS low_quality
      FROM (SELECT *, {ratio('markdown')} AS r FROM (SELECT *, {m} AS markdown FROM ({BRONZE.format(noise=lit(noise))})))"""


JUDGED = """SELECT doc_id, source AS category, lower(coalesce(text, '') || CASE WHEN doc_id % 7 = 0 THEN ' Điều 5. Vượt xe trên đường' WHEN doc_id % 5 = 0 THEN ' mức phí' ELSE '' END) AS body,
        ['Nghi Dinh 100 2019 ND-CP', 'Nghi Dinh 67 2023', 'Tin'][doc_id % 11 % 3 + 1] AS top FROM documents"""


def judged(rows: str = JUDGED, topics: dict[str, list[str]] = TOPICS, core: list[str] = CORE) -> str:
    """Verdicts on ``rows`` (doc_id, category, body in lower case, top)."""
    h = {f'"{t}"': hits("body", w) for t, w in topics.items()}
    most = "greatest(" + ", ".join(h) + ")"
    best = "CASE " + " ".join(f"WHEN {t} = {most} AND {most} > 0 THEN {lit(t[1:-1])}" for t in h) + " END"
    driving = r"(?i)điều\s+\d+\.\s*(" + "|".join(n.replace(" ", r"\s+") for n in fixed.DRIVING_RULES) + ")"
    excluded = " OR ".join(f"contains(lower(top), {lit(x)})" for x in fixed.EXCLUDED_TITLES)
    insured = " OR ".join(f"contains(body, {lit(x)})" for x in fixed.INSURANCE_WORDS)
    core = ", ".join(map(lit, core))
    default = "CASE category " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.DEFAULT_TOPICS.items()) + f" ELSE '{fixed.FALLBACK_TOPIC}' END"
    why = fixed.REASONS
    rule = f"""CASE WHEN {excluded} THEN 1 WHEN regexp_matches(body, {lit(driving)}) THEN 2 WHEN contains(lower(top), '{fixed.INSURANCE_TITLE}') AND NOT ({insured}) THEN 3
      WHEN contains(body, 'about: blank') AND length({strip('body')}) < 100 THEN 4 WHEN category IN ({core}) THEN 5 WHEN most > 0 THEN 6 ELSE 7 END"""
    return f"""
    SELECT doc_id, rule IN (5, 6) AS admitted, CASE rule WHEN 5 THEN coalesce(best, {default}) WHEN 6 THEN best END AS topic,
      CASE rule WHEN 5 THEN 0.95::DOUBLE WHEN 6 THEN round(least(1.0::DOUBLE, 0.5::DOUBLE + most * 0.1::DOUBLE), 2) ELSE 0.0::DOUBLE END AS consultation_score,
      CASE rule WHEN 1 THEN {lit(why['excluded'])} || top WHEN 2 THEN {lit(why['driving'])} WHEN 3 THEN {lit(why['insurance'])} WHEN 4 THEN {lit(why['noise'])} WHEN 5 THEN {lit(why['core'])} WHEN 6 THEN {lit(why['topic'])} ELSE {lit(why['none'])} END AS reason
    FROM (SELECT *, {rule} AS rule FROM (SELECT *, {most} AS most, {best} AS best FROM (SELECT *, {', '.join(f'{v} AS {k}' for k, v in h.items())} FROM ({rows}))))"""


ITEMS = "SELECT min(doc_id) AS item, arg_min(lang, doc_id) AS topic, lower(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY lower(text)"
def pairs(threshold: float) -> str:
    return f"""
  SELECT a, b, round(c::DOUBLE / (na + nb - c), 6) AS jaccard FROM (
    SELECT x.item AS a, y.item AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
    FROM sh x JOIN sh y ON x.topic = y.topic AND x.s = y.s AND x.item < y.item AND least(x.n, y.n) >= 0.8 * greatest(x.n, y.n) GROUP BY 1, 2)
  WHERE c::DOUBLE / (na + nb - c) >= {threshold}"""


def greedy(threshold: float) -> str:
    """WITH of items, merged (item, "into"): items in ascending order, each gone if an earlier neighbour is not."""
    return f"""{SHINGLED.replace('WITH', 'WITH RECURSIVE', 1)}, near AS MATERIALIZED ({pairs(threshold)}),
  node AS MATERIALIZED (SELECT b AS item, list(a) AS earlier, row_number() OVER (ORDER BY b) AS k FROM near GROUP BY b),
  walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS gone UNION ALL
    SELECT n.k, CASE WHEN len(list_filter(n.earlier, lambda e: NOT list_contains(w.gone, e))) > 0 THEN list_append(w.gone, n.item) ELSE w.gone END FROM walk w JOIN node n ON n.k = w.k + 1),
  gone AS (SELECT unnest(gone) AS item FROM (SELECT gone FROM walk ORDER BY k DESC LIMIT 1)),
  merged AS (SELECT b AS item, min(a) AS "into" FROM near WHERE b IN (FROM gone) AND a NOT IN (FROM gone) GROUP BY b)"""


SHINGLED = f"WITH sets AS (SELECT item, topic, {shingle_list('text')} AS l FROM ({ITEMS})), sh AS (SELECT item, topic, len(l) AS n, unnest(l) AS s FROM sets WHERE len(l) >= 5)"
def section_sql(docs: str) -> str:
    """Headings outside fences, by windows over the lines."""
    t, levels = strip("line"), range(1, 7)
    legal = f"regexp_matches(t, {lit('(?i)' + fixed.LEGAL_HEADING)}) AND length(t) < 80"
    level = f"CASE WHEN t LIKE '```%' OR coalesce(inside, 0) % 2 = 1 THEN NULL WHEN regexp_matches(t, '^#{{1,6}}\\s+.+$') THEN length(regexp_extract(t, '^(#+)', 1)) WHEN {legal} THEN CASE WHEN lower(t) LIKE 'chương%' THEN 2 ELSE 3 END END"
    title = f"CASE WHEN t LIKE '#%' THEN {strip(replace_all('t', '^#{1,6}' + chr(92) + 's+', ''))} ELSE t END"
    path = ", ".join(f"CASE WHEN p{k} > greatest(-1{''.join(f', coalesce(p{j}, -1)' for j in range(1, k))}) THEN h{k} END" for k in levels)
    last = ", ".join(f"last_value(CASE WHEN level = {k} THEN pos END IGNORE NULLS) OVER w AS p{k}, last_value(CASE WHEN level = {k} THEN title END IGNORE NULLS) OVER w AS h{k}" for k in levels)
    return f"""
  WITH lines AS (SELECT doc_id, unnest(string_split(markdown, chr(10))) AS line, generate_subscripts(string_split(markdown, chr(10)), 1) - 1 AS pos FROM ({docs})),
  fenced AS (SELECT *, sum((t LIKE '```%')::INTEGER) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inside FROM (SELECT *, {t} AS t FROM lines)),
  heads AS (SELECT *, {level} AS level, {title} AS title FROM fenced),
  marked AS (SELECT *, (sum((level IS NOT NULL)::INTEGER) OVER w)::INTEGER AS section, {last} FROM heads WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
  grouped AS (SELECT doc_id, section, any_value(concat_ws(' > ', {path})) AS path,
    {strip("string_agg(line, chr(10) ORDER BY pos)")} AS body FROM marked WHERE level IS NULL GROUP BY 1, 2)
  SELECT doc_id, section, path, body FROM grouped WHERE body <> ''"""


def chunk_sql(docs: str, size: int = 512, overlap: int = 80, least: int = 40) -> str:
    """Sections packed sentence by sentence; a row a step: (section, step, sentences held, their length, piece that is full)."""
    whole = f"length(body) <= {size} OR len(list_filter(string_split(body, chr(10)), lambda l: {strip('l')} LIKE '|%')) > 0"
    x, n = "l.s[p.i + 1]", "len(p.cur)"
    sums = lambda j: f"coalesce(list_sum(list_transform(p.cur[{n} - {j} + 1:], lambda y: length(y))), 0)"
    full = f"(p.n + length({x}) > {size} AND {n} > 0)"
    piece = strip("array_to_string(cur, ' ')")
    return f"""
  WITH RECURSIVE secs AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY doc_id, section) AS sid, {whole} AS whole FROM ({section_sql(docs)})),
  lists AS MATERIALIZED (SELECT doc_id AS sid, list(sentence ORDER BY nth) AS s FROM ({sentence_sql("(SELECT sid AS doc_id, body AS text FROM secs WHERE NOT whole)")}) GROUP BY doc_id),
  packed AS (
    SELECT sid, 0 AS i, []::VARCHAR[] AS cur, 0::BIGINT AS n, NULL::VARCHAR AS piece FROM lists
    UNION ALL
    SELECT sid, i + 1, CASE WHEN is_full THEN list_append(cur[len(cur) - k + 1:], x) ELSE list_append(cur, x) END, CASE WHEN is_full THEN tail ELSE n END + length(x), CASE WHEN is_full THEN {piece} END
    FROM (SELECT p.sid, p.i, p.cur, p.n, {x} AS x, {full} AS is_full, k, {sums('k')} AS tail
      FROM (SELECT *, len(list_filter(range(1, {n} + 1), lambda j: {sums('j')} <= {overlap})) AS k FROM packed p) p JOIN lists l USING (sid) WHERE p.i < len(l.s))),
  pieces AS (
    SELECT sid, 0 AS i, body AS piece FROM secs WHERE whole
    UNION ALL SELECT sid, i, piece FROM packed WHERE piece IS NOT NULL
    UNION ALL SELECT sid, i + 1, {piece} FROM packed p JOIN lists l USING (sid) WHERE p.i = len(l.s)),
  numbered AS (SELECT doc_id, path, row_number() OVER (PARTITION BY doc_id ORDER BY section, i) - 1 AS chunk_index, CASE WHEN path <> '' THEN '[' || path || ']' || chr(10) ELSE '' END || piece AS content
    FROM pieces JOIN secs USING (sid) WHERE length(piece) >= {least})
  SELECT doc_id || '_' || chunk_index AS chunk_id, doc_id, chunk_index::INTEGER AS chunk_index, path AS heading_context, {n_words('content')} AS token_estimate, length(content)::INTEGER AS char_count, md5(content) AS digest FROM numbered"""


FORWARD = "SELECT conv_id, turn, role, text, coalesce(last_value(CASE WHEN role = 'user' THEN coalesce(text, '') END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 'none') AS question FROM conversations"


def page_lines(x: str) -> str:
    s = strip("l")
    shaped = f"CASE WHEN regexp_matches({s}, {lit('(?i)' + fixed.PAGE_NUMBER)}) THEN '' ELSE {strip(replace_all(s, '(?i)' + fixed.PRINT_MARK, ''))} END"
    head = f"CASE WHEN regexp_matches(y, {lit('(?i)' + fixed.CHAPTER)}) THEN chr(10) || '## ' || y || chr(10) WHEN regexp_matches(y, {lit('(?i)' + fixed.ARTICLE)}) THEN chr(10) || '### ' || y || chr(10) ELSE y END"
    return f"list_filter(list_transform(list_transform(string_split({x}, chr(10)), lambda l: {shaped}), lambda y: {head}), lambda z: z <> '')"


def sentence_sql(docs: str = "documents") -> str:
    """Ends of sentences are marked with chr(1), marks after honorifics taken away again."""
    edge, one = r"(^|[^\p{L}\p{N}_./])", "|".join(fixed.HONORIFICS)
    more = "|".join(h.replace(".", r"\.") for h in fixed.HONORIFICS_DOTTED)
    x = f"replace(regexp_replace(p, {lit(r'([.!?…])([ ' + chr(9) + r']\s*)([A-ZÀ-ỹ' + chr(34) + chr(39) + '(“‘0-9])')}, '\\1~@~\\2\\3', 'g'), '~@~', chr(1))"
    x = f"regexp_replace({x}, {lit(f'{edge}((?i:{one})[.])' + chr(1))}, '\\1\\2', 'g')"
    x = f"regexp_replace({x}, {lit(f'{edge}((?i:{more})[.]+)' + chr(1))}, '\\1\\2', 'g')"
    unit = "regexp_matches(p, '^[#*>|-]|^```')"
    parts = f"list_filter(list_transform(string_split({x}, chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"
    paragraphs = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {strip('l')}), lambda l: l <> '')"
    return f"""
    SELECT doc_id, generate_subscripts(l, 1)::INTEGER - 1 AS nth, unnest(l) AS sentence FROM (
      SELECT doc_id, flatten(list_transform({paragraphs}, lambda p: CASE WHEN {unit} THEN [p] ELSE {parts} END)) AS l FROM {docs})"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["boilerplate_strip"] = f"SELECT ord AS doc_id, {boilerplate('raw_content')} AS clean FROM ({BRONZE.format(noise=lit(NOISE))})"
    out["tone_rewrite"] = f"SELECT doc_id, {tones('coalesce(text, chr(0)[:0]) || ' + lit(' ' + SAMPLES[0] + SAMPLES[3]))} AS modern FROM documents".replace("chr(0)[:0]", "''")
    noise = "\n" + SAMPLES[1] + "\n\n\n " + SAMPLES[2] + SAMPLES[4]
    out["typography"] = f"SELECT doc_id, {typography('t')} AS typed FROM (SELECT doc_id, coalesce(text, '') || {lit(noise)} AS t FROM documents)"
    out["normalize"] = f"SELECT ord AS doc_id, {normalize('raw_content')} AS normal FROM ({BRONZE.format(noise=lit(chr(10) + chr(10).join(SAMPLES)))})"
    values = " UNION ALL ".join(f"SELECT 'v{i}', {lit(t)}" for i, t in enumerate(NFD))
    out["nfc_normalize"] = f"SELECT k, nfc_normalize(t) AS composed FROM (SELECT doc_id || 'd' AS k, text AS t FROM documents UNION ALL {values})"
    out["quality"] = f"SELECT doc_id, round(r, 6) AS ratio, {score('t', 'r')} AS score, {gate('t', 'r')} AS passed FROM (SELECT doc_id, coalesce(text, '') AS t, {ratio('coalesce(text, chr(32)[:0])')} AS r FROM documents)".replace("chr(32)[:0]", "''")
    out["plain_text"] = f"SELECT doc_id, {plain('markdown')} AS plain, {n_words('markdown')} AS n_words, length(markdown)::INTEGER AS n_chars FROM ({HEADED})"
    out["sentence_split"] = sentence_sql()
    out["shingle_sets"] = f"SELECT doc_id, len(l)::INTEGER AS n, md5(array_to_string(l, ',')) AS digest FROM (SELECT doc_id, {shingle_list('text')} AS l FROM documents WHERE text IS NOT NULL)"
    key = f"lower({strip(replace_all(replace_all('markdown', '^[' + chr(92) + 's#*' + chr(92) + '->|]+', ''), chr(92) + 's+', ' '))})"
    out["dedup_keys"] = f"SELECT doc_id, sha256({key}) AS key FROM ({HEADED})"
    out["exact_doc_dedup"] = "SELECT min(doc_id) AS doc_id, sha256(coalesce(text, '')) AS checksum, 'doc_' || sha256(coalesce(text, ''))[:16] AS name FROM documents GROUP BY sha256(coalesce(text, ''))"
    out["silver_documents"] = f"""
    SELECT ord, 'doc_' || checksum[:16] AS doc_id, raw_id AS source_id, source_type, {normalize(f"coalesce(nullif(title, ''), {lit('Tài liệu không tiêu đề')})")} AS title, coalesce(nullif(category, ''), 'general') AS category, 'vi' AS language,
      markdown AS content_clean_markdown, p AS content_plain_text, {n_words('p')} AS word_count, length(markdown)::INTEGER AS char_count, {n_words('markdown')} AS token_estimate, round(r, 4) AS diacritic_ratio, quality_score, checksum AS checksum_sha256
    FROM (SELECT *, {plain('markdown')} AS p, sha256(markdown) AS checksum, row_number() OVER (PARTITION BY sha256(markdown) ORDER BY ord) AS nth FROM ({flagged(NOISE)}) WHERE NOT low_quality) WHERE nth = 1"""
    out["silver_report"] = f"""
    WITH f AS (SELECT *, row_number() OVER (PARTITION BY markdown, low_quality ORDER BY ord) AS nth FROM ({flagged('')}))
    SELECT count(*)::BIGINT AS total, count(*) FILTER (NOT low_quality AND nth = 1)::BIGINT AS documents, count(*) FILTER (NOT low_quality AND nth > 1)::BIGINT AS duplicates, count(*) FILTER (low_quality)::BIGINT AS low_quality,
      round(avg(quality_score) FILTER (NOT low_quality AND nth = 1), 3) AS average_quality FROM f"""
    out["source_histogram"] = "SELECT coalesce(nullif(source, ''), 'general') AS category, count(*) AS n FROM documents GROUP BY 1"
    out["heading_sections"] = section_sql(HEADED)
    out["silver_chunks"] = chunk_sql(HEADED)
    body = "coalesce(text, '')"
    fenced = f"""SELECT doc_id, replace('# A~| x | y |~|---|---|~' || repeat('| 1 | 2 |~', (doc_id % 50 + 1)::BIGINT) || '## B~```py~# hidden~Điều 1. hidden~', '~', chr(10)) || {body} || replace('~```~  Chương I Chung~', '~', chr(10)) || {body} ||
      chr(10) || 'điều 2. Phạm vi' || chr(10) || {body} || ' end' || chr(10) || '##### Deep' || chr(10) || {body} || replace('~# Last~```~# open to the end', '~', chr(10)) AS markdown FROM documents"""
    out["table_and_fence"] = f"SELECT doc_id, section, path, length(body)::INTEGER AS n_chars, md5(body) AS digest FROM ({section_sql(fenced)})"
    titled = "SELECT doc_id, '# ' || source || chr(10) || coalesce(text, '') AS markdown FROM documents"
    out["chunk_sizes"] = f"""
    SELECT doc_id || '_' || nth AS chunk_id, path AS heading_context, content, {n_words('content')} AS token_estimate, length(content)::INTEGER AS char_count FROM (
      SELECT doc_id, path, row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS nth, '[' || path || ']' || chr(10) || body AS content FROM ({section_sql(titled)}) WHERE length(body) >= 40)"""
    h = {t: hits("lower(text)", w) for t, w in TOPICS.items()}
    most = f"greatest({', '.join(h.values())})"
    out["topic_hits"] = f"SELECT doc_id, {', '.join(f'{v} AS {k}' for k, v in h.items())}, CASE {' '.join(f'WHEN {v} = {most} AND {most} > 0 THEN {lit(k)}' for k, v in h.items())} END AS best, {most} AS most FROM documents"
    out["gold_cascade"] = judged()
    out["gold_drop_reasons_top10"] = f"SELECT reason, n FROM (SELECT reason, count(*) AS n, min(doc_id) AS first FROM ({judged()}) WHERE NOT admitted GROUP BY reason ORDER BY n DESC, first LIMIT 10)"
    rows = "[" + ", ".join(f"[{lit(words)}, {lit(category)}]" for words, category in taxonomy_rows()) + "]"
    made = f"SELECT doc_id, rows[k][2] AS category, lower(coalesce(text, '') || ' ' || rows[k][1]) AS body, '' AS top FROM (SELECT doc_id, text, {rows} AS rows, doc_id % {len(taxonomy_rows())} + 1 AS k FROM documents)"
    out["real_taxonomy"] = f"SELECT doc_id AS ord, admitted, topic, consultation_score, reason FROM ({judged(made, fixed.TOPICS, fixed.CORE_CATEGORIES)})"
    out["gold_report"] = f"SELECT count(*) AS total, count(*) FILTER (admitted) AS admitted, round((count(*) FILTER (admitted))::DOUBLE * 100.0 / count(*), 2) AS retention FROM ({judged()})"
    titles = "CASE WHEN doc_id % 13 = 0 THEN source || ' Cho vay' ELSE source END"
    out["doc_existence_or_rule"] = f"SELECT doc_id, title FROM (SELECT doc_id, {titles} AS title, source FROM documents) WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0) OR source IN ({', '.join(map(lit, CORE))}) OR ({' OR '.join(f'contains(lower(title), {lit(w)})' for w in fixed.LEGAL_TITLE_WORDS)})"
    out["exact_chunk_dedup"] = f"""
    WITH c AS (SELECT doc_id, doc_id % 3 AS depth, (doc_id % 2) / 2.0::DOUBLE AS score, {key.replace('markdown', 'text')} AS k FROM documents WHERE text IS NOT NULL)
    SELECT min(doc_id) AS ord, arg_max(doc_id, score * 1e12 + depth * 1e9 - doc_id)::VARCHAR AS doc_id, max(score) AS consultation_score, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS sources, (count(*) - 1)::INTEGER AS duplicate_count FROM c WHERE k <> '' GROUP BY k"""
    out["jaccard_pairs"] = SHINGLED + pairs(0.5)
    out["near_dedup_greedy"] = greedy(0.5) + ' SELECT item, "into" FROM merged'
    out["near_dedup_strict"] = greedy(0.9) + ' SELECT item, "into" FROM merged'
    out["near_dedup_merge"] = f"""{greedy(0.5)} SELECT i.item AS ord, concat_ws(',', i.item, string_agg(m.item, ',' ORDER BY m.item)) AS sources, count(m.item)::INTEGER AS near_duplicate_merged
      FROM ({ITEMS}) i LEFT JOIN merged m ON m."into" = i.item WHERE i.item NOT IN (SELECT item FROM merged) GROUP BY i.item"""
    out["faq_forward_fill"] = f"SELECT conv_id, turn, question, text AS answer FROM ({FORWARD}) WHERE role = 'assistant'"
    out["faq_group_concat"] = f"""
    SELECT 'faq_doc_' || md5(lower(replace(category || '_' || subcategory, ' ', '_')))[:10] AS doc_id, category, subcategory, md5(content) AS digest, length(content)::INTEGER AS n_chars, n AS total_questions FROM (
      SELECT category, subcategory, '# ' || category || chr(10) || '## ' || subcategory || chr(10, ) || chr(10) || string_agg('### ' || question || chr(10) || chr(10) || coalesce(text, '') || chr(10), chr(10) ORDER BY conv_id, turn) AS content, count(*) AS n
      FROM (SELECT *, 'c' || conv_id % 3 AS category, 's' || conv_id % 5 AS subcategory FROM ({FORWARD}) WHERE role = 'assistant') GROUP BY 1, 2)""".replace("chr(10, )", "chr(10)")
    out["name_tags"] = "SELECT conv_id, turn, array_to_string(list_filter(['The ', 'Que', 'un', 'zzz'], lambda x: contains(lower(coalesce(text, '')), lower(x)) OR contains('und', lower(x))), ',') AS tags FROM conversations"
    words = " OR ".join(f"contains(lower(href), {lit(w)})" for w in fixed.TWO_WHEELERS)
    out["page_links"] = f"""
    SELECT page_id, nth, CASE WHEN starts_with(href, '/') THEN 'https://example.org' || href ELSE href END AS link FROM (
      SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1)::INTEGER - 1 AS nth FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))
    WHERE NOT ({words}) AND (contains(href, '/t') OR contains(href, '/a') OR contains(href, '/d') OR contains(href, 'http'))"""
    parts = r"replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), 'www.', '') AS h, trim(regexp_replace(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '[^a-zA-Z0-9_\-]+', '_', 'g'), '_') AS s"
    out["url_parse_slug"] = f"SELECT page_id, h AS host, replace(h, '.', '_') || CASE WHEN s <> '' THEN '_' || s ELSE '' END AS slug FROM (SELECT page_id, {parts} FROM pages)"
    bad = " OR ".join(f"contains({c}, {lit(w)})" for c in ("lower(t)", "lower(url)") for w in fixed.TWO_WHEELERS) + " OR " + " OR ".join(f"contains(lower(url), {lit(w)})" for w in fixed.LAW_PORTALS + fixed.LAW_PATHS)
    out["url_validity"] = f"SELECT page_id, url <> '' AND t <> '' AND NOT ({bad} OR c = 0 OR (c = 1 AND NOT contains(lower(url), 'blog'))) AS valid FROM (SELECT page_id, url, page_id % 3 AS c, CASE WHEN page_id % 17 = 0 THEN 'Xe máy mới' WHEN page_id % 19 = 0 THEN '' ELSE 'Tin' END AS t FROM pages)"
    portal = " OR ".join(f"contains(lower(url), {lit(w)})" for w in fixed.LAW_PORTALS)
    known = f"""
      SELECT * FROM (SELECT title, url, rank, ord, row_number() OVER (PARTITION BY url ORDER BY rank, ord) AS k FROM (
        SELECT * FROM (VALUES ('Tin một', 'https://seed.example/one', 0, 1::BIGINT), ('Xe máy', 'https://seed.example/two', 0, 2), ('Tin một', 'https://seed.example/one', 0, 3), ('', 'https://seed.example/three', 0, 4)) v(title, url, rank, ord)
        UNION ALL SELECT 'Tin ' || page_id, regexp_replace(url, '[?#].*', ''), 1, page_id FROM pages
      ) WHERE url <> '' AND title <> '' AND NOT ({bad.replace("lower(t)", "lower(title)")})) WHERE k = 1"""
    out["url_discovery"] = f"SELECT title, url, rank, ord FROM ({known})"
    named = f"SELECT url, rank, ord, trim(regexp_replace(title, '[^a-zA-Z0-9_-]+', '_', 'g'), '_') || '.html' AS file FROM ({known}) WHERE NOT ({portal})"
    once = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY rank, ord) AS nth FROM ({named})) WHERE nth = 1"
    out["crawl_plan_status"] = f"SELECT file, url, CASE WHEN file IN (SELECT 'Tin_' || doc_id || '.html' FROM documents) THEN 'cached' ELSE 'pending' END AS status FROM ({once})"
    out["crawl_page_cap"] = f"SELECT file, rank, ord, 'pending' AS status FROM ({once}) ORDER BY rank, ord LIMIT 20"
    out["print_manifest_paths"] = """
      SELECT d.doc_id, coalesce(a.path, b.path) AS path FROM documents d
      LEFT JOIN (SELECT source || '/' || doc_id || '.pdf' AS path FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) a ON a.path = d.source || '/' || d.doc_id || '.pdf'
      LEFT JOIN (SELECT DISTINCT page_id || '.pdf' AS path FROM pages) b ON b.path = d.doc_id || '.pdf' WHERE coalesce(a.path, b.path) IS NOT NULL"""
    out["gold_output_order"] = "SELECT doc_id, source AS topic, min(doc_id) OVER (PARTITION BY source) AS topic_ord FROM documents"
    out["fetch_outcomes"] = "SELECT page_id, CASE WHEN length(coalesce(html, '')) > 500 THEN 'success' WHEN coalesce(url, '') <> '' THEN 'cached' ELSE 'failed' END AS status FROM pages"
    out["url_first_seen"] = "SELECT min(page_id) AS page_id, arg_min(address, page_id) AS address FROM (SELECT page_id, regexp_replace(url, '[?#].*', '') AS address FROM pages) GROUP BY regexp_extract(address, '^[a-z]+://([^/:?#]+)', 1)"
    out["manifest_anti_upsert"] = "SELECT doc_id AS file, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'labelled' FROM labels"
    out["manifest_inner"] = "SELECT doc_id, source, quality FROM documents JOIN labels USING (doc_id)"
    out["catalog_left_default"] = "SELECT d.doc_id, coalesce(any_value('quality ' || q), 'document ' || d.doc_id) AS name, count(*) AS n FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id GROUP BY d.doc_id"
    provinces = ", ".join(f"({lit(n)}, {fee}::BIGINT)" for _, n, fee in fixed.KEY_PROVINCES)
    out["cross_fee_matrix"] = f"""
    SELECT p_partkey AS car_id, p_name AS car_name, p_type AS trim_name, province_name, price AS list_price_vnd, 0::BIGINT AS registration_fee_vnd, plate AS license_plate_fee_vnd, {fixed.INSPECTION_FEE}::BIGINT AS inspection_fee_vnd, {fixed.ROAD_FEE}::BIGINT AS road_fee_vnd,
      {fixed.INSURANCE_FEE}::BIGINT AS mandatory_insurance_vnd, price + plate + {fixed.INSPECTION_FEE + fixed.ROAD_FEE + fixed.INSURANCE_FEE} AS total_rolling_cost_vnd
    FROM (SELECT *, CASE WHEN p_size > 5 THEN floor(p_retailprice * 1000)::BIGINT ELSE 0 END AS price FROM part), (VALUES {provinces}) v(province_name, plate) WHERE price > 0"""
    out["deposit_tier"] = "SELECT o_orderkey, price, CASE WHEN price > 1000000000 THEN 50000000 ELSE 15000000 END::BIGINT AS deposit FROM (SELECT o_orderkey, floor(o_totalprice * 5000)::BIGINT AS price FROM orders)"
    retail = "p_retailprice::DECIMAL(12,2)::VARCHAR"
    texts = f"CASE p_size % 5 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN p_name ELSE {retail} END AS p, CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN {retail} ELSE p_size || 'e3' END AS b"
    out["price_falsy_chain"] = f"SELECT p_partkey, floor(coalesce(try_cast(coalesce(nullif(nullif(p, ''), '0'), nullif(nullif(b, ''), '0'), '0') AS DOUBLE), 0))::BIGINT AS price_vnd FROM (SELECT p_partkey, {texts} FROM part)"
    out["label_left_zero"] = "SELECT l AS lang, count(lang) AS n FROM (VALUES ('en'), ('fr'), ('de'), ('es'), ('vi')) v(l) LEFT JOIN documents ON lang = l GROUP BY l"
    out["union_sources_ordered"] = "SELECT r AS source_rank, count(*) AS n, min(id) AS first, max(id) AS last FROM (SELECT 0 AS r, doc_id AS id FROM documents UNION ALL SELECT 1, page_id FROM pages UNION ALL SELECT 2, conv_id FROM conversations) GROUP BY r"
    out["head_n"] = "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 2"
    out["json_nav_explode"] = "SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(length(props), 0)::INTEGER AS n_chars FROM events"
    part = "SELECT p_partkey, coalesce(p_brand, '') AS brand, coalesce(p_type, '') AS type, coalesce(p_name, '') AS name, p_size AS size FROM part"
    out["json_map_lookup"] = f"SELECT p_partkey, brand AS model, unnest([type, 'small one', 'none']) AS edition, unnest([name, 'small one', 'none']) AS label, unnest([size, 7, 0])::BIGINT AS price FROM ({part})"
    out["lineitem_by_flag"] = "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY 1, 2"
    out["semi_and_anti"] = "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) THEN 'with' ELSE 'without' END AS kind FROM customer"
    out["running_window"] = "SELECT event_id, (row_number() OVER w)::INTEGER AS nth, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS running FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
    n = "(n_chars * 37)"
    out["file_sizes"] = f"SELECT doc_id, CASE WHEN {n} < 1024 THEN {n} || ' B' WHEN {n} / 1024.0 < 1024 THEN printf('%.1f KB', {n}::DOUBLE / 1024) ELSE printf('%.1f MB', {n}::DOUBLE / 1048576) END AS size FROM documents"
    pages = ["Trang 1 / 3\nChương II Quy định\n9/30/26, 12:16 PM about: blank\nĐiều 4. Phạm vi\nnội dung một", "- 2 -\n3/7\n\nPage 4 of 9\nnội dung hai about: blank", "cuối"]
    shaped = [f"array_to_string(list_append({page_lines(x)}, ''), chr(10))" for x in map(lit, pages)]
    last = f"CASE WHEN {strip(chr(116))} = '' THEN '' ELSE array_to_string(list_append({page_lines('t')}, ''), chr(10)) END"
    out["printed_pages"] = f"SELECT doc_id, {strip('concat_ws(chr(10), ' + lit('# Tài liệu' + chr(10)) + ', ' + ', '.join(shaped) + ', ' + last + ')')} AS markdown FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)"
    return out
