"""SQL (DuckDB) for the rows of those corpus queries that SQL can state."""

from __future__ import annotations

from daybook.llm import chat, crc, importance, licenses, line_rules, negatives, ring

_ESCAPE = chat.CONTROL.replace("++", "*").replace("*+", "*")


def _escaped(column: str) -> str:
    return f"regexp_replace({column}, '{_ESCAPE}', '\\1\\\\\\2\\3', 'g')"


CHAT = f"""
    WITH turns AS (
             SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
             UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
         marked AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{chat.LEARNED}'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = '{chat.LEARNED}'), '')) AS loss_sha256,
           CAST(sum(length({_escaped('text')}) + CASE WHEN before IS DISTINCT FROM role
                    THEN {len(chat.START + chat.SAYS + chat.END)} + length({_escaped('role')}) ELSE {len(chat.NEXT)} END) AS BIGINT) AS formatted_chars
    FROM marked GROUP BY conv_id
"""

_TEMPLATES = ", ".join(f"('{name}', '{licenses.license_of(name)}', {licenses.bigrams_of(text)!r})" for name, text in licenses.EVERY.items())
_OUTDONE = " OR ".join(f"a.license = '{family}' AND starts_with(b.license, '{start}')" for family, starts in licenses.SHARED.items() for start in starts)
_WORDS = "list_filter(string_split_regex({}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"

LICENSES = f"""
    WITH docs AS (SELECT doc_id, lower(coalesce(text, '')) AS text FROM documents),
         lines AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
         marked AS (SELECT doc_id, regexp_replace(line, '([.!?])[\\x20\\x09-\\x0D]+', '\\1' || chr(1), 'g') AS line FROM lines),
         whole AS (SELECT doc_id, regexp_replace(text, '([.!?])[\\x20\\x09-\\x0D]+', '\\1' || chr(1), 'g') AS text FROM docs),
         passages AS (
             SELECT doc_id, line AS passage FROM lines UNION SELECT doc_id, text FROM docs
             UNION SELECT doc_id, unnest(string_split(line, chr(1))) FROM marked
             UNION SELECT doc_id, unnest(string_split(text, chr(1))) FROM whole
             UNION SELECT doc_id, unnest(string_split_regex(text, '\\n[\\x20\\x09\\x0B-\\x0D]*\\n')) FROM docs),
         worded AS (SELECT doc_id, row_number() OVER () AS n, {_WORDS.format('passage')} AS w FROM passages),
         paired AS (SELECT doc_id, n, unnest(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS pair FROM worded),
         sizes AS (SELECT n, count(*) AS size FROM paired GROUP BY n),
         templates AS (SELECT name, license, own, len(own) AS size FROM (VALUES {_TEMPLATES}) AS t(name, license, own)),
         parts AS (SELECT name, license, size, unnest(own) AS pair FROM templates),
         scored AS (SELECT doc_id, n, name, license, 2.0 * count(*) / (any_value(s.size) + any_value(t.size)) AS dice
                    FROM paired JOIN parts t USING (pair) JOIN sizes s USING (n) GROUP BY doc_id, n, name, license),
         best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, n ORDER BY dice DESC, name) AS place FROM scored),
         named AS (SELECT doc_id, license, min({{'low': -dice, 'name': name}}).name AS template, CAST(max(dice) AS DOUBLE) AS dice, count(*) AS passages
                   FROM best WHERE place = 1 AND dice >= {licenses.LEAST} GROUP BY doc_id, license)
    SELECT * FROM named a WHERE NOT EXISTS (SELECT 1 FROM named b WHERE a.doc_id IS NOT DISTINCT FROM b.doc_id AND ({_OUTDONE}))
"""

_LEFT = "n_words - n_removed"

RULES = f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
         worded AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM docs),
         windows AS (SELECT r, i, list_slice(words, i, i + 4) AS own FROM (
                         SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM worded WHERE len(words) >= 5)),
         again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, own) AS n FROM windows) WHERE n > 1),
         covered AS (SELECT r, count(DISTINCT i + d) AS n FROM again, range(5) AS t(d) GROUP BY r),
         lines AS (SELECT r, doc_id, host, unnest(string_split(text, chr(10))) AS line FROM docs),
         filled AS (SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS own
                    FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
         doubled AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM filled GROUP BY r),
         hosts AS (SELECT host, count(DISTINCT doc_id) AS n FROM docs GROUP BY host),
         shared AS (SELECT host, own FROM filled JOIN hosts USING (host) GROUP BY host, own
                    HAVING count(DISTINCT doc_id) >= {line_rules.SHARED} AND count(DISTINCT doc_id) > {line_rules.SHARE} * any_value(hosts.n)),
         removed AS (SELECT r, sum(len(string_split(own, ' '))) AS n FROM filled JOIN shared USING (host, own) GROUP BY r),
         figures AS (
             SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                    CAST(coalesce(doubled.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
                    CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed
             FROM worded LEFT JOIN covered USING (r) LEFT JOIN doubled USING (r) LEFT JOIN removed USING (r)),
         failed AS (SELECT *, n_words < {line_rules.LEAST_WORDS} OR 100 * n_repeat_words > {line_rules.MOST_REPEATED} * n_words AS base_failed
                    FROM figures)
    SELECT *, NOT base_failed AND {_LEFT} >= {line_rules.LEAST_WORDS} AND {_LEFT} >= {line_rules.LEAST_SHARE} * n_words AS kept FROM failed
"""

#: CRC-32 byte by byte; ``crc_table`` is built from the polynomial.
_CRC_TABLE = f"""crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                 lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {crc.POLYNOMIAL}) ELSE c >> 1 END)) AS tab)"""


def _crc(column: str) -> str:
    octets = f"list_transform(range(1, 2 * strlen({column}), 2), lambda i: CAST('0x' || substr(hex({column}), i, 2) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(4294967295, {octets}), "
            "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)")


def _hex(text: str, digits: int) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


def _shards(shards: int) -> str:
    """The ring in rounds: in round ``step`` each arc's rest goes to the shard of the node so many places on."""
    used = [f"used{s} + sum(CASE WHEN owner = {s} THEN taken ELSE 0 END) OVER () AS used{s}" for s in range(shards)]
    room = "CASE owner " + " ".join(f"WHEN {s} THEN total // {shards} + CAST({s} < total % {shards} AS INT) - used{s}" for s in range(shards)) + " END"
    before = "CASE owner " + " ".join(f"WHEN {s} THEN used{s}" for s in range(shards)) + " END"
    names = ", ".join(f"used{s}" for s in range(shards))
    nodes = shards * ring.NODES
    return f"""
    WITH RECURSIVE {_CRC_TABLE},
         docs AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, coalesce(text, '') AS text FROM documents),
         sums AS (SELECT text, {_crc('text')} AS text_crc32 FROM (SELECT DISTINCT text FROM docs), crc_table),
         keyed AS (SELECT doc_id, size, text_crc32, {_hex("coalesce(doc_id::VARCHAR, '')", ring.GRID_DIGITS)} AS place,
                          row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1 AS copy FROM docs JOIN sums USING (text)),
         nodes AS (SELECT row_number() OVER (ORDER BY place, owner, copy) - 1 AS node, owner, place FROM (
                       SELECT s AS owner, c AS copy, {_hex("s || '/' || c", ring.GRID_DIGITS)} AS place
                       FROM range({shards}) AS a(s), range({ring.NODES}) AS b(c))),
         homes AS (SELECT place, min(node) AS node FROM nodes GROUP BY place),
         arcs AS (SELECT k.*, coalesce(h.node, 0) AS node FROM keyed k ASOF LEFT JOIN homes h ON k.place <= h.place),
         turned AS (SELECT *, {_hex(f"coalesce(doc_id::VARCHAR, '') || '/' || size || '/' || text_crc32 || '/' || copy // {ring.LOT}", ring.TURN_DIGITS)} AS turn FROM arcs),
         ranked AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY turn, doc_id, size, text_crc32, copy) - 1 AS rank FROM turned),
         demand AS (SELECT node, count(r.rank) AS n FROM nodes LEFT JOIN ranked r USING (node) GROUP BY node),
         flow AS (
             SELECT 0 AS step, node, n AS rest, CAST(0 AS BIGINT) AS first, CAST(0 AS BIGINT) AS taken, -1 AS owner, CAST(0 AS BIGINT) AS base,
                    CAST(sum(n) OVER () AS BIGINT) AS total, {', '.join(f'CAST(0 AS HUGEINT) AS used{s}' for s in range(shards))} FROM demand
             UNION ALL
             SELECT step + 1, node, rest - taken, first, taken, owner, base, total, {', '.join(used)}
             FROM (SELECT *, CAST(greatest(0, least(rest, room - ahead)) AS BIGINT) AS taken, CAST(used + least(ahead, room) AS BIGINT) AS base
                   FROM (SELECT f.step, f.node, f.rest, f.first + f.taken AS first, f.total, {names}, n.owner, {room.replace('owner', 'n.owner')} AS room,
                                {before.replace('owner', 'n.owner')} AS used,
                                coalesce(sum(f.rest) OVER (PARTITION BY n.owner ORDER BY f.node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
                         FROM flow f JOIN nodes n ON n.node = (f.node + f.step) % {nodes}
                         WHERE f.step < {nodes} AND EXISTS (SELECT 1 FROM flow WHERE rest > 0))))
    SELECT r.doc_id, r.size, r.text_crc32, 'rows' AS law, CAST(f.owner AS INTEGER) AS shard, f.base + r.rank - f.first AS slot,
           CAST(NULL AS INTEGER) AS grown_shard, CAST(h.owner AS INTEGER) AS home
    FROM ranked r JOIN flow f ON r.node = f.node AND r.rank >= f.first AND r.rank < f.first + f.taken JOIN nodes h ON h.node = r.node
"""


SHARDS = _shards(8)

_RUNS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

IMPORTANCE = f"""
    WITH {_CRC_TABLE},
         docs AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS} AS words FROM documents),
         own AS (SELECT r, unnest(words) AS word FROM docs),
         aim AS (SELECT unnest({_RUNS}) AS word FROM benchmark),
         buckets AS (SELECT word, {_crc('word')} % {importance.BUCKETS} AS bucket
                     FROM (SELECT word FROM own UNION SELECT word FROM aim), crc_table),
         held AS (SELECT bucket, count(*) AS n FROM own JOIN buckets USING (word) GROUP BY bucket),
         wanted AS (SELECT bucket, count(*) AS n FROM aim JOIN buckets USING (word) GROUP BY bucket),
         totals AS (SELECT (SELECT count(*) FROM own) AS held, (SELECT count(*) FROM aim) AS wanted),
         gains AS (SELECT b.bucket, CAST(floor({importance.SCALE} * ln(CAST((coalesce(w.n, 0) + 1) * (t.held + {importance.BUCKETS}) AS DOUBLE)
                       / ((coalesce(h.n, 0) + 1) * (t.wanted + {importance.BUCKETS})))) AS BIGINT) AS gain
                   FROM (SELECT DISTINCT bucket FROM buckets) b LEFT JOIN held h USING (bucket) LEFT JOIN wanted w USING (bucket), totals t),
         means AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
                   FROM own JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
         scored AS (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-{importance.SCALE} * ln(
                        -ln((CAST('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
                    FROM docs LEFT JOIN means USING (r)),
         placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
                    FROM scored WHERE n_features >= {importance.LEAST_WORDS})
    SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * {importance.PERCENT} // 100 THEN rank END AS rank
    FROM scored LEFT JOIN placed USING (r)
"""

NEGATIVES = f"""
    WITH taking AS (
             SELECT vec_id, CASE WHEN vec_id % {negatives.MOVED} = 0 THEN (label + 1) % {negatives.LABELS} ELSE label END AS label,
                    list_transform(embedding, lambda x: floor({negatives.SCALE} * CAST(x AS DOUBLE))) AS v
             FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         pairs AS (SELECT a.vec_id AS anchor_id, a.label AS own, a.v AS av, r.label = a.label AS same, r.vec_id AS id,
                          CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
                   FROM (SELECT DISTINCT * FROM taking WHERE vec_id % {negatives.EVERY} = 0) a JOIN taking r ON a.vec_id <> r.vec_id),
         near AS (SELECT *, row_number() OVER (PARTITION BY anchor_id, own, av ORDER BY score DESC, id) AS place FROM pairs WHERE same),
         found AS (SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (
                              PARTITION BY p.anchor_id, p.own, p.av, p.place ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
                          n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
                   FROM near p JOIN pairs n ON p.anchor_id = n.anchor_id AND p.own = n.own AND p.av = n.av AND NOT n.same
                        AND {negatives.LOW} * p.score <= 100 * n.score AND 100 * n.score <= {negatives.HIGH} * p.score
                   WHERE p.place <= {negatives.POSITIVES})
    SELECT * FROM found WHERE rank <= {negatives.NEGATIVES}
"""
