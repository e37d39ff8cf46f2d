"""The queries that SQL can express, as DuckDB SQL over the same tables, by definition."""

from __future__ import annotations

from rollcall.llm.mixing import BLOCK, REPEATS, SHARDS

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_BLANK = r"[^\x20\x09-\x0D]+"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({LOWER.format(f"coalesce({text}, '')")}, '{pattern}')"


def _shingles(words: str, size: int) -> str:
    """Distinct runs of words; none of a text with fewer."""
    return f"list_distinct([array_to_string({words}[i : i + {size - 1}], ' ') FOR i IN range(1, len({words}) - {size - 2})])"


def _components(ids: str, links: str) -> str:
    """(id, component): the smallest id reachable over links a - b, given in both directions."""
    return f"""reach(id, other) AS (
      SELECT id, id FROM ({ids}) UNION SELECT r.id, l.b FROM reach r JOIN ({links}) l ON r.other = l.a),
    joined AS (SELECT id, min(other) AS component FROM reach GROUP BY id)"""


DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_words('text', PLAIN)} AS w FROM documents),
items AS (SELECT item_id, {_words('text', PLAIN)} AS w FROM benchmark),
held AS (SELECT doc_id, unnest({_shingles('w', 5)}) AS s FROM docs
  {' '.join(f"UNION ALL SELECT doc_id, unnest({_shingles('w', k)}) FROM docs WHERE EXISTS (SELECT 1 FROM items WHERE len(w) = {k})" for k in range(1, 5))}),
sets AS (SELECT item_id, CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')] ELSE {_shingles('w', 5)} END AS asked FROM items),
asked AS (SELECT item_id, len(asked) AS n_item, unnest(asked) AS s FROM sets)
SELECT doc_id, item_id, CAST(count(*) AS INTEGER) AS n_shared, CAST(n_item AS INTEGER) AS n_item,
  CAST(count(*) AS DOUBLE) / n_item AS containment
FROM held JOIN asked USING (s) GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""

EMBEDDING_LINKS = f"""
WITH RECURSIVE units AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM units x JOIN units y
    ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.9),
{_components('SELECT vec_id AS id FROM embeddings', 'SELECT a, b FROM links')}
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component AS component_id,
  e.vec_id = component AS kept
FROM embeddings e JOIN joined ON id = e.vec_id
"""

LINE_DEDUP = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
  SELECT *, {LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM placed),
keepers AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keeper <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN keepers USING (key) GROUP BY doc_id
"""

NEAR_DEDUP = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_words('text', NOT_BLANK)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN {_shingles('w', 4)} WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM texts),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM members x JOIN members y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
{_components('SELECT doc_id AS id FROM documents', 'SELECT a, b FROM links')},
classes AS (
  SELECT doc_id, s, CASE WHEN len(s) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY list_sort(s)) END AS class_id FROM sets)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component AS component_id, doc_id = component AS kept, class_id
FROM classes JOIN joined ON id = doc_id
"""


def _highest_quotients(cells: str, group: str, order: str) -> str:
    """``cells`` with seats: all quotients of each group ranked, the first ``total`` of them won."""
    return f"""(SELECT c.*, coalesce(won, 0) AS seats FROM {cells} c LEFT JOIN (
      SELECT {group}, cell, count(*) AS won FROM (
        SELECT {group}, cell, total, row_number() OVER (PARTITION BY {group} ORDER BY votes / (2 * k + 1) DESC, {order}) AS place
        FROM (SELECT *, unnest(range(0, total + 1)) AS k FROM {cells}) WHERE votes > 0)
      WHERE place <= total GROUP BY {group}, cell) USING ({group}, cell))"""


MIXING = f"""
WITH ordered AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS source_key,
    CAST(len(regexp_extract_all(coalesce(text, ''), '{NOT_BLANK}')) AS BIGINT) AS size,
    md5(concat_ws('|', '17', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS place
  FROM documents),
docs AS (SELECT *, CAST('0x' || place[1:7] AS BIGINT) % {SHARDS} AS shard FROM ordered),
sizes AS (SELECT source_key, source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY ALL),
weighted AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight, {REPEATS} * source_size AS filled FROM sizes),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sizes) - coalesce(sum(filled) OVER before, 0)) / sum(weight) OVER rest AS level
  FROM weighted WINDOW
    before AS (ORDER BY filled / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY filled / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
common AS (SELECT arg_min(level, filled / weight) AS level FROM levels WHERE level * weight <= filled),
targets AS (
  SELECT source_key, source, source_size, CAST(least(CAST(filled AS DOUBLE), weight * coalesce(common.level, 'Infinity'::DOUBLE)) AS DOUBLE) AS target
  FROM levels, common),
all_blocks AS (
  SELECT 0 AS everything, source_key AS cell, source, source_size, target, target AS votes,
    CAST(round((SELECT sum(source_size) FROM sizes) / {BLOCK}) AS BIGINT) AS total FROM targets),
of_sources AS (SELECT cell AS source_key, source_size, target, seats AS total
  FROM {_highest_quotients('all_blocks', 'everything', 'source ASC NULLS LAST')}),
cells AS (
  SELECT source_key, shard AS cell, CAST(sum(size) AS BIGINT) AS words, CAST(sum(size) AS DOUBLE) AS votes, any_value(total) AS total,
    any_value(source_size) AS source_size, any_value(target) AS target
  FROM docs JOIN of_sources USING (source_key) GROUP BY source_key, shard),
quotas AS (
  SELECT source_key, cell AS shard, words, source_size, target,
    CASE WHEN target >= {REPEATS} * source_size THEN {REPEATS} * words ELSE least({REPEATS} * words, seats * {BLOCK}) END AS quota,
    CASE WHEN words > 0 THEN CAST('0x' || md5('17|' || source_key || '|' || cell)[1:7] AS BIGINT) % CAST(ceil(words / {BLOCK}) AS BIGINT) * {BLOCK}
      ELSE 0 END AS low
  FROM {_highest_quotients('cells', 'source_key', 'cell')}),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source_key, shard ORDER BY place, size ROWS UNBOUNDED PRECEDING) AS stop FROM docs),
spans AS (
  SELECT *, stop - size AS start, CASE WHEN words > 0 THEN quota // words ELSE 0 END AS passes FROM placed JOIN quotas USING (source_key, shard)),
cut AS (SELECT *, low + quota - passes * words AS high FROM spans)
SELECT doc_id, size, source_size, target, CAST(passes * size
  + greatest(0, least(stop, least(high, words)) - greatest(start, low)) + greatest(0, least(stop, high - words) - start) AS BIGINT) AS taken
FROM cut
"""

# Bytes as two hexadecimal digits each; a window of 50 bytes is 100 of them. Pieces of 1000 windows
# keep substr from walking through whole texts.
SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
pieces AS (
  SELECT doc_id, c, substr(x, 2000 * c + 1, 2098) AS y
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2000 + 1)) AS c FROM texts)),
windows AS (
  SELECT doc_id, 1000 * c + j AS k, substr(y, 2 * j + 1, 100) AS s
  FROM (SELECT doc_id, c, y, unnest(range(0, least(1000, length(y) // 2 - 49))) AS j FROM pieces)),
holders AS (SELECT s, min(doc_id) AS holder FROM windows GROUP BY s),
lost AS (
  SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before
  FROM windows JOIN holders USING (s) WHERE holder < doc_id),
islands AS (
  SELECT doc_id, k, count(*) FILTER (WHERE before IS NULL OR k > before + 50) OVER (PARTITION BY doc_id ORDER BY k) AS island FROM lost),
spans AS (SELECT doc_id, min(k) AS a, max(k) + 50 AS b FROM islands GROUP BY doc_id, island),
gaps AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(a) AS n_spans,
  sha256(unhex(coalesce(string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a), '')
    || substr(x, 2 * coalesce(max(b), 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN gaps USING (doc_id) GROUP BY doc_id, x
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _merkle(fanout: int = 16, heights: tuple[int, int] = (6, 3)) -> str:
    """Trees of at most so many levels below and above the sources' roots."""
    crc = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1))))"""
    leaf = lambda text: f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
    steps = [
        f"""docs AS (SELECT doc_id, source, {leaf('text')} AS leaf,
      CASE WHEN {crc} % 5 = 0 THEN {leaf(LOWER.format('text'))} ELSE {leaf('text')} END AS folded,
      row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place FROM documents)""",
        """a0 AS (SELECT source, place, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM docs)""",
    ]

    def levels(name: str, height: int) -> None:
        for k in range(height):
            steps.append(
                f"""{name}{k + 1} AS (SELECT source, place // {fanout} AS place, list(digest ORDER BY place) AS run,
      CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE any_value(digest) END AS digest,
      (any_value(n) + {fanout - 1}) // {fanout} AS n, any_value(n) > 1 AS several FROM {name}{k} GROUP BY source, place // {fanout})"""
            )

    def climb(before: str, name: str, height: int, place: str) -> str:
        for k in range(height):
            slot = f"(p.{place} // {fanout**k} % {fanout})"
            left, right = f"array_to_string(run[:{slot}], '')", f"array_to_string(run[{slot} + 2:], '')"
            steps.append(
                f"""on_{name}{k} AS (SELECT p.* EXCLUDE (proof, folded), CASE WHEN several THEN proof || {left} || {right} ELSE proof END AS proof,
      CASE WHEN several THEN sha256({left} || folded || {right}) ELSE folded END AS folded
      FROM {before} p JOIN {name}{k + 1} x ON x.source IS NOT DISTINCT FROM p.{'source' if name == 'a' else 'every'}
        AND x.place = p.{place} // {fanout ** (k + 1)})"""
            )
            before = f"on_{name}{k}"
        return before

    levels("a", heights[0])
    steps.append(f"""b0 AS (SELECT 'all' AS source, row_number() OVER (ORDER BY source ASC NULLS FIRST) - 1 AS place, source AS own,
      digest, count(*) OVER () AS n FROM a{heights[0]})""")
    levels("b", heights[1])
    steps.append("starts AS (SELECT docs.*, '' AS proof FROM docs)")
    top = climb("starts", "a", heights[0], "place")
    steps.append(f"""tops AS (SELECT p.*, b0.place AS tree, 'all' AS every, b0.digest AS subroot
      FROM {top} p JOIN b0 ON b0.own IS NOT DISTINCT FROM p.source)""")
    top = climb("tops", "b", heights[1], "tree")
    chain = ",\n".join(steps)
    return f"""WITH {chain}
SELECT doc_id, leaf, subroot, (SELECT digest FROM b{heights[1]}) AS root, sha256(proof) AS proof_sha256,
  folded AS folded_root, folded = (SELECT digest FROM b{heights[1]}) AS verified FROM {top}"""


FILL_MIDDLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^
]*
|[^
]+') AS lines,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM texts),
parts AS (
  SELECT *, array_to_string(lines[:least(x, y)], '') AS prefix, array_to_string(lines[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(lines[greatest(x, y) + 1:], '') AS suffix FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

STATEMENTS = {
    "op1_decontamination": DECONTAMINATION,
    "op3_embedding_dedup": EMBEDDING_LINKS,
    "op4_line_dedup": LINE_DEDUP,
    "op7_near_dedup": NEAR_DEDUP,
    "op9_mixing": MIXING,
    "op11_suffix_dedup": SUFFIX_DEDUP,
    "op12_merkle": _merkle(),
    "op13_fill_middle": FILL_MIDDLE,
}
