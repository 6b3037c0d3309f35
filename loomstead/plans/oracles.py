"""The registered queries once more, in the SQL DuckDB runs on the same tables."""

from .facts import AS_OF, CUSTOMER, PART
from .inputs import BASE_TS, BATCH_TS

# -- views --------------------------------------------------------------------------------

NOTES = """notes AS (
  SELECT id, document, metadata, embedding, metadata::JSON->>'$.wing' AS wing,
    metadata::JSON->>'$.room' AS room, metadata::JSON->>'$.source_file' AS source_file
  FROM (SELECT concat('doc_', doc_id) AS id, text AS document, embedding,
      concat('{"wing":"', lang, '"',
        CASE WHEN n_chars >= 500 THEN concat(',"room":"', source, '"') ELSE '' END,
        ',"source_file":"corpus/', lang, '/', source, '.txt","chunk":', n_chars // 1000,
        ',"pinned":', CASE WHEN n_chars >= 5000 THEN 'true' ELSE 'false' END, '}') AS metadata
    FROM documents LEFT JOIN embeddings ON doc_id = vec_id))"""

TALKS = """talks AS (
  SELECT concat('talk_', conv_id, '_', turn) AS id, text AS document, conv_id, turn,
    concat('{"wing":"', role, '","room":"', conv_id, '"}') AS metadata
  FROM conversations)"""

PROTOTYPES = """prototypes AS (
  SELECT query_id, list(x ORDER BY i) AS embedding FROM (
    SELECT label::BIGINT AS query_id, i, avg(x::DOUBLE) AS x FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY query_id)"""

PURCHASES = """purchases AS (
  SELECT l_orderkey::DECIMAL(18,0)::DECIMAL(38,0) * 1000000000000000000::DECIMAL(38,0)
      + l_linenumber::DECIMAL(38,0) * 100000000000000000::DECIMAL(38,0)
      + l_partkey::DECIMAL(38,0) * 100000::DECIMAL(38,0)
      + date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::DECIMAL(38,0) AS seq,
    c_name AS subject_name, p_name AS object_name,
    replace(replace(lower(c_name), ' ', '_'), '''', '') AS subject,
    CASE WHEN l_returnflag = 'R' THEN 'sent_back' ELSE 'bought_item' END AS predicate,
    replace(replace(lower(p_name), ' ', '_'), '''', '') AS object,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL
      WHEN l_returnflag = 'A' THEN strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00Z'
      ELSE strftime(l_shipdate, '%Y-%m-%d') END AS valid_from,
    CASE WHEN l_linestatus = 'O' THEN NULL
      ELSE strftime(l_shipdate + to_days(l_linenumber * 30), '%Y-%m-%d') END AS valid_to,
    CASE WHEN l_discount > 0 THEN 1 - l_discount ELSE 1.0 END AS confidence,
    o_orderstatus AS source_closet, o_orderpriority AS adapter_name, l_shipdate, o_orderdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""


def _start(c):
    return (
        f"CASE WHEN strlen({c}) = 10 AND substr({c}, 5, 1) = '-' AND substr({c}, 8, 1) = '-' "
        f"THEN {c} || 'T00:00:00Z' ELSE {c} END"
    )


def _end(c):
    return _start(c).replace("T00:00:00Z", "T23:59:59Z")


def _valid(key):
    return (
        f"(valid_from IS NULL OR {_start('valid_from')} <= {key}) "
        f"AND (valid_to IS NULL OR {_end('valid_to')} >= {key})"
    )


TRIPLES = f"{PURCHASES}, triples AS (SELECT 'f_' || seq::VARCHAR AS id, * FROM purchases)"

CUSTOMERS = f"""customers AS (
  SELECT DISTINCT replace(replace(lower(c_name), ' ', '_'), '''', '') AS id, c_name AS name,
    'customer' AS type, '{BASE_TS[:10]}' AS created FROM customer)"""

ENTITIES = f"""{CUSTOMERS}, entities AS (SELECT * FROM customers UNION ALL
  SELECT DISTINCT replace(replace(lower(p_name), ' ', '_'), '''', ''), p_name, 'part',
    '{BASE_TS[:10]}' FROM part WHERE p_name <> 'red bolt')"""

MIXED = """mixed AS (
  SELECT concat(role, ':', text) AS id, text AS document,
    concat('{"wing":"', role, '","room":"', conv_id, '"}') AS metadata, 64 AS width, NULL AS source_file,
    conv_id::VARCHAR AS room FROM conversations
  UNION ALL
  SELECT url, html,
    CASE WHEN url LIKE '%?%' THEN split_part(url, '?', -1) ELSE concat('{"source_file":"', url, '"}') END, 64,
    CASE WHEN url LIKE '%?%' THEN NULL ELSE url END, NULL FROM pages
  UNION ALL
  SELECT concat('vec_', vec_id), NULL, concat('{"room":"', label, '"}'),
    CASE WHEN label = 9 THEN 63 ELSE 64 END, NULL, label::VARCHAR FROM embeddings),
bad AS (SELECT * FROM (
  SELECT 'mixed' AS "table", id, source_file, room,
    CASE WHEN NOT starts_with(metadata, '{') THEN 'metadata is not a JSON object'
      WHEN width <> 64 THEN concat('embedding has ', width, ' components, not 64')
      WHEN length(id) > 191 THEN 'id is longer than 191 characters'
      WHEN length(room) > 255 THEN 'room is longer than 255 characters'
      WHEN length(source_file) > 512 THEN 'source_file is longer than 512 characters' END AS error,
    substr(coalesce(document, ''), 1, 200) AS doc_preview FROM mixed) WHERE error IS NOT NULL)"""

MANIFEST = """files AS (
  SELECT concat('corpus/', lang, '/', source, '/', n_chars // 1000, '.jsonl') AS path,
    max(documents.doc_id)::DOUBLE AS mtime, count(*) AS drawers, count(quality) AS n_labelled
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1),
manifest AS (SELECT *, CASE WHEN n_labelled > 0 THEN 'done' ELSE 'pending' END AS status FROM files)"""

# word counts hashed the way the default embedder does it
def _hashed(name, source):
    return f"""{name} AS (
  WITH words AS (SELECT id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}),
  slots AS (SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS slot,
      sum(CASE WHEN strpos('02468ace', substr(md5(w), 9, 1)) > 0 THEN 1 ELSE -1 END)::DOUBLE AS n
    FROM words GROUP BY ALL),
  lengths AS (SELECT id, sqrt(sum(n * n)) AS length FROM slots GROUP BY id),
  dense AS (SELECT id, i, coalesce(n / nullif(length, 0), 0)::FLOAT AS x
    FROM (SELECT id FROM {source}) CROSS JOIN (SELECT unnest(range(64)) AS i)
    LEFT JOIN slots USING (id) LEFT JOIN lengths USING (id) WHERE slot = i
    UNION ALL
    SELECT s.id, i, 0::FLOAT FROM {source} s CROSS JOIN (SELECT unnest(range(64)) AS i)
    WHERE NOT EXISTS (SELECT 1 FROM slots WHERE slots.id = s.id AND slot = i))
  SELECT id, list(x ORDER BY i) AS embedding FROM dense GROUP BY id)"""


TOTAL = "len({0}) AS n, round(list_sum(list_transform({0}::DOUBLE[], lambda x, i: x * i)), 6) AS total"


def _with(*parts):
    return "WITH " + ", ".join(parts) + " "


def _notes(rest):
    return _with(NOTES) + rest


def _facts(rest):
    return _with(ENTITIES, TRIPLES) + rest


# -- search -------------------------------------------------------------------------------

KNN = """hits AS (SELECT query_id, id, document, metadata, distance,
    row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
  FROM (SELECT query_id, n.id, document, metadata,
      round(list_cosine_distance(n.embedding::DOUBLE[], q.embedding::DOUBLE[]), 9) AS distance
    FROM {rows} n, {queries} q WHERE n.embedding IS NOT NULL {where}
      AND list_sum(list_transform(n.embedding, lambda x: x * x)) > 0
      AND list_sum(list_transform(q.embedding, lambda x: x * x)) > 0)
  QUALIFY rank <= 10)"""


def _knn(columns, rows="notes", queries="prototypes", where="", views=(NOTES, PROTOTYPES)):
    return _with(*views, KNN.format(rows=rows, queries=queries, where=where)) + (
        f"SELECT query_id, rank::INT AS rank, id, round(distance, 6) AS distance{columns} FROM hits"
    )


CENTRE = """centre AS (SELECT 0::BIGINT AS query_id, list(x ORDER BY i) AS embedding FROM (
  SELECT i, avg(x::DOUBLE) AS x FROM (
    SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i))"""

# -- facts --------------------------------------------------------------------------------

SHOWN = "valid_from, valid_to, confidence, source_closet, valid_to IS NULL AS current"


def _entity(name, sides, as_of=None):
    slug = name.lower().replace(" ", "_").replace("'", "")
    valid = f" AND {_valid(_quoted_key(as_of))}" if as_of else ""
    parts = {
        "outgoing": f"""SELECT 'outgoing' AS direction, '{name}' AS subject, predicate, name AS object, {SHOWN}
          FROM triples JOIN entities e ON object = e.id WHERE subject = '{slug}'{valid}""",
        "incoming": f"""SELECT 'incoming' AS direction, name AS subject, predicate, '{name}' AS object, {SHOWN}
          FROM triples JOIN entities e ON subject = e.id WHERE object = '{slug}'{valid}""",
    }
    return _facts(" UNION ALL ".join(parts[s] for s in sides))


def _quoted_key(as_of):
    return f"'{as_of}T00:00:00Z'"


NAMED = """s.name AS subject, predicate, o.name AS object, valid_from, valid_to, valid_to IS NULL AS current
  FROM triples t JOIN entities s ON t.subject = s.id JOIN entities o ON t.object = o.id"""


def _timeline(where=""):
    return _facts(f"SELECT {NAMED} {where} ORDER BY t.valid_from NULLS LAST, t.id LIMIT 100")


def _fact_id(ts):
    return (
        "concat('t_', subject, '_', predicate, '_', object, '_', "
        f"substr(sha256(concat(coalesce(valid_from, 'None'), '{ts}', seq::VARCHAR)), 1, 12))"
    )


def _added(source, name="added"):
    """Rows of ``source`` in call order with the open fact each one would meet."""
    return f"""{name} AS (SELECT *,
      first_value(CASE WHEN valid_to IS NULL THEN new_id END IGNORE NULLS) OVER earlier AS met
    FROM (SELECT *, {_fact_id(BATCH_TS)} AS new_id FROM {source})
    WINDOW earlier AS (PARTITION BY subject, predicate, object ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


STORED = "id, subject, predicate, object, valid_from, valid_to, confidence"
CUT = "TIMESTAMP '1998-01-01 00:00:00'"

LATER = _with(
    PURCHASES,
    f"early AS (SELECT * FROM purchases WHERE l_shipdate < {CUT})",
    f"late AS (SELECT * FROM purchases WHERE l_shipdate >= {CUT})",
    _added("late"),
    f"""stored AS (SELECT subject, predicate, object, min_by({_fact_id(BASE_TS)}, seq) AS stored_id
      FROM early WHERE valid_to IS NULL GROUP BY ALL)""",
) + """SELECT seq, CASE WHEN stored_id IS NOT NULL OR met IS NOT NULL THEN 'existing' ELSE 'inserted' END AS status,
  coalesce(stored_id, met, new_id) AS fact_id, NULL::VARCHAR AS reason
FROM added LEFT JOIN stored USING (subject, predicate, object)"""

INVALIDATION = (
    PURCHASES,
    "opened AS (SELECT * FROM purchases WHERE valid_to IS NULL)",
    _added("opened"),
    """endings AS (SELECT seq, subject, predicate, object, valid_to AS ended
      FROM purchases WHERE valid_to IS NOT NULL)""",
    f"""store AS (SELECT *, new_id AS id, {_start('valid_from')} AS start FROM added WHERE met IS NULL)""",
    f"""tried AS (SELECT e.*, s.id IS NOT NULL AS found,
        coalesce({_end('ended')} < s.start, false) AS late
      FROM endings e LEFT JOIN store s USING (subject, predicate, object))""",
    """closing AS (SELECT subject, predicate, object, min(seq) AS closed_at, min_by(ended, seq) AS ended
      FROM tried WHERE found AND NOT late GROUP BY ALL)""",
)

EVENTS = f"""events_in AS (
  SELECT event_id AS seq, CASE WHEN event_type = 'error' THEN 'end' ELSE 'add' END AS kind,
    concat('user_', user_id) AS subject, 'subscribed_to' AS predicate, 'service' AS object,
    CASE WHEN event_type IN ('error', 'signup') THEN NULL
      ELSE strftime(ts + to_hours(floor(value)::INT), '%Y-%m-%dT%H:%M:%SZ') END AS valid_from,
    CASE WHEN event_type = 'purchase' THEN strftime(ts + to_days(30), '%Y-%m-%dT%H:%M:%SZ') END AS valid_to,
    CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS ended
  FROM events),
checked AS (SELECT *, CASE WHEN kind = 'add' THEN {_fact_id(BATCH_TS)} END AS new_id,
    kind = 'add' AND coalesce(valid_to < valid_from, false) AS inverted FROM events_in),
ordered AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY seq) AS step
  FROM checked WHERE NOT inverted)"""

FOLD = f"""{EVENTS}, fold AS (
  SELECT seq, kind, subject, step, new_id, NULL::VARCHAR AS open_before, NULL::VARCHAR AS start_before,
    CASE WHEN kind = 'add' AND valid_to IS NULL THEN new_id END AS open_after,
    CASE WHEN kind = 'add' AND valid_to IS NULL THEN coalesce(valid_from, '') END AS start_after, ended
  FROM ordered WHERE step = 1
  UNION ALL
  SELECT o.seq, o.kind, o.subject, o.step, o.new_id, f.open_after, f.start_after,
    CASE WHEN o.kind = 'end' THEN CASE WHEN o.ended < f.start_after THEN f.open_after END
      WHEN f.open_after IS NOT NULL THEN f.open_after
      WHEN o.valid_to IS NULL THEN o.new_id END,
    CASE WHEN o.kind = 'end' THEN CASE WHEN o.ended < f.start_after THEN f.start_after END
      WHEN f.open_after IS NOT NULL THEN f.start_after
      WHEN o.valid_to IS NULL THEN coalesce(o.valid_from, '') END, o.ended
  FROM fold f JOIN ordered o ON o.subject = f.subject AND o.step = f.step + 1)"""

JUDGED = f"""{FOLD}, judged AS (
  SELECT seq, kind, CASE
      WHEN kind = 'end' AND open_before IS NULL THEN 'nothing open'
      WHEN kind = 'end' AND ended < start_before THEN 'rejected'
      WHEN kind = 'end' THEN 'closed'
      WHEN open_before IS NOT NULL THEN 'existing' ELSE 'inserted' END AS status,
    CASE WHEN kind = 'end' THEN CASE WHEN ended >= start_before THEN open_before END
      ELSE coalesce(open_before, new_id) END AS fact_id, ended
  FROM fold
  UNION ALL
  SELECT seq, kind, 'rejected', NULL, ended FROM checked WHERE inverted)"""

SPARSE = EVENTS.replace("event_id AS seq", "event_id * 1000000 AS seq")
SPARSE_JUDGED = f"""{SPARSE}, stored AS (
  SELECT concat('s_', c_custkey) AS id, concat('user_', c_custkey % 50) AS subject,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('2024-01-', lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0')) END AS valid_from,
    CASE WHEN c_custkey > 150 THEN '2024-06-01' END AS valid_to
  FROM customer WHERE c_custkey % 3 <> 0),
entered AS (SELECT subject, min(id) AS id, max(coalesce({_start('valid_from')}, '')) AS start FROM stored WHERE valid_to IS NULL GROUP BY subject),
fold AS (
  SELECT NULL::BIGINT AS seq, NULL::VARCHAR AS kind, subject, 0::BIGINT AS step, NULL::VARCHAR AS new_id, NULL::VARCHAR AS open_before,
    NULL::VARCHAR AS start_before, e.id AS open_after, e.start AS start_after, NULL::VARCHAR AS ended
  FROM (SELECT DISTINCT subject FROM ordered) LEFT JOIN entered e USING (subject)
  UNION ALL
  SELECT o.seq, o.kind, o.subject, o.step, o.new_id, f.open_after, f.start_after,
    CASE WHEN o.kind = 'end' THEN CASE WHEN o.ended < f.start_after THEN f.open_after END
      WHEN f.open_after IS NOT NULL THEN f.open_after
      WHEN o.valid_to IS NULL THEN o.new_id END,
    CASE WHEN o.kind = 'end' THEN CASE WHEN o.ended < f.start_after THEN f.start_after END
      WHEN f.open_after IS NOT NULL THEN f.start_after
      WHEN o.valid_to IS NULL THEN coalesce(o.valid_from, '') END, o.ended
  FROM fold f JOIN ordered o ON o.subject = f.subject AND o.step = f.step + 1){JUDGED.removeprefix(FOLD)}"""

PEOPLE = """people AS (SELECT c_custkey AS seq,
    CASE WHEN c_acctbal > 5000 THEN concat('O''', c_name)
      ELSE upper(c_name[1]) || lower(c_name[2:]) END AS name,
    CASE WHEN c_acctbal < 0 THEN 'debtor' ELSE 'person' END AS type,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'f' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'm' ELSE '' END AS gender,
    CASE WHEN c_acctbal > 2000 THEN '1990-05-06' END AS birthday,
    CASE WHEN c_acctbal > 3000 THEN upper(n_name[1]) || lower(n_name[2:]) END AS parent,
    CASE WHEN c_acctbal > 4000 THEN upper(r_name[1]) || lower(r_name[2:]) END AS partner,
    c_mktsegment AS segment,
    CASE WHEN c_acctbal > 6000 THEN n_name END AS sibling,
    CASE WHEN c_acctbal > 7000 THEN r_name END AS owner,
    CASE WHEN c_acctbal > 0 THEN [r_name, c_mktsegment] ELSE [] END AS interests
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
calls AS (
  SELECT seq, 0 AS step, name, 'child_of' AS predicate, parent AS other, birthday AS valid_from
    FROM people WHERE parent IS NOT NULL
  UNION ALL SELECT seq, 1, name, 'married_to', partner, NULL FROM people WHERE partner IS NOT NULL
  UNION ALL SELECT seq, 2, name, 'is_child_of', coalesce(parent, name), birthday
    FROM people WHERE segment = 'BUILDING'
  UNION ALL SELECT seq, 2, name, 'is_partner_of', coalesce(partner, upper(name[1]) || lower(name[2:])), NULL
    FROM people WHERE segment = 'AUTOMOBILE'
  UNION ALL SELECT seq, 2, name, 'is_sibling_of',
    upper(coalesce(sibling, name)[1]) || lower(coalesce(sibling, name)[2:]), NULL
    FROM people WHERE segment = 'MACHINERY'
  UNION ALL SELECT seq, 2, name, 'is_pet_of',
    upper(coalesce(owner, name)[1]) || lower(coalesce(owner, name)[2:]), NULL
    FROM people WHERE segment = 'HOUSEHOLD'
  UNION ALL SELECT seq, 2 + i, name, 'loves', upper(interests[i][1]) || lower(interests[i][2:]), '2025-01-01'
    FROM people, (SELECT unnest([1, 2]) AS i) WHERE len(interests) >= i),
slugs AS (SELECT *, replace(replace(lower(name), ' ', '_'), '''', '') AS subject,
    replace(replace(lower(other), ' ', '_'), '''', '') AS object FROM calls)"""


ORACLES = {
    "collection_scan": _notes(
        "SELECT id, metadata, wing, room, source_file, length(document)::INT AS chars, "
        "embedding IS NOT NULL AS embedded FROM notes"
    ),
    "snapshot_load": _notes("SELECT id, document, metadata, wing, room, source_file, embedding IS NOT NULL AS embedded FROM notes"),
    "where_empty": _notes("SELECT id FROM notes"),
    "where_eq": _notes("SELECT id FROM notes WHERE wing = 'en'"),
    "where_implicit_and": _notes(
        "SELECT id FROM notes WHERE wing = 'en' AND metadata::JSON->>'$.pinned' = 'true'"
    ),
    "where_and": _notes("SELECT id FROM notes WHERE wing = 'de' AND room = 'src3'"),
    "where_or": _notes("SELECT id FROM notes WHERE wing = 'fr' OR metadata::JSON->>'$.pinned' = 'true'"),
    "where_nested": _notes(
        "SELECT id FROM notes WHERE (wing = 'es' AND metadata::JSON->>'$.chunk' = '1') "
        "OR (wing = 'fr' AND metadata::JSON->>'$.chunk' = '2')"
    ),
    "where_eq_op": _notes("SELECT id FROM notes WHERE wing = 'fr'"),
    "where_scalar": _notes("SELECT id FROM notes WHERE metadata::JSON->>'$.chunk' = '2'"),
    "get_where": _notes("SELECT id, document, metadata FROM notes WHERE source_file = 'corpus/en/src3.txt'"),
    "get_ids": _notes(
        "SELECT id, document, metadata FROM notes WHERE id IN (SELECT concat('doc_', doc_id) FROM labels)"
    ),
    "get_ids_where": _notes(
        "SELECT id, document, metadata FROM notes WHERE id IN (SELECT concat('doc_', doc_id) FROM labels) "
        "AND (wing = 'de' OR wing = 'fr')"
    ),
    "get_include": _notes(f"SELECT id, document, {TOTAL.format('embedding')} FROM notes WHERE embedding IS NOT NULL"),
    "get_page_deep": _notes("SELECT id, document, metadata FROM notes ORDER BY id LIMIT 130 OFFSET 170"),
    "get_rest": _notes("SELECT id, metadata FROM notes ORDER BY id OFFSET 60"),
    "get_page": _notes("SELECT id, document, metadata FROM notes ORDER BY id LIMIT 20 OFFSET 40"),
    "get_flat_result": _notes(
        "SELECT string_agg(id, '|' ORDER BY id) AS ids, string_agg(document, '|' ORDER BY id) AS documents, "
        "string_agg(metadata, '|' ORDER BY id) AS metadatas "
        "FROM (SELECT * FROM notes WHERE wing = 'en' ORDER BY id LIMIT 20)"
    ),
    "metadata_map": _notes(
        "SELECT id, key, metadata::JSON->>key AS value FROM "
        "(SELECT id, metadata, unnest(json_keys(metadata)) AS key FROM notes)"
    ),
    "vector_text_roundtrip": f"SELECT vec_id AS id, {TOTAL.format('embedding')} FROM embeddings",
    "vector_scrub": "SELECT id, len(v) AS n, round(list_sum(list_transform(v::DOUBLE[], lambda x, i: x * i)), 6) AS total FROM (SELECT vec_id AS id, "
    "list_transform(embedding, lambda x: CASE WHEN x > 0.2 OR x < -0.2 THEN 0 ELSE x END) AS v FROM embeddings)",
    "count": _notes("SELECT count(*) AS n FROM notes"),
    "count_by_wing": _notes("SELECT coalesce(wing, 'unknown') AS wing, count(*) AS n FROM notes GROUP BY 1"),
    "count_by_room": _notes("SELECT coalesce(room, 'unknown') AS room, count(*) AS n FROM notes GROUP BY 1"),
    "count_by_source_file": _notes(
        "SELECT coalesce(source_file, 'unknown') AS source_file, count(*) AS n FROM notes GROUP BY 1"
    ),
    "count_by_where": _notes(
        "SELECT coalesce(room, 'unknown') AS room, count(*) AS n FROM notes "
        "WHERE wing = 'en' AND metadata::JSON->>'$.pinned' = 'true' GROUP BY 1"
    ),
    "count_tree": _notes(
        "SELECT coalesce(wing, 'unknown') AS wing, coalesce(room, 'unknown') AS room, count(*) AS n "
        "FROM notes GROUP BY 1, 2"
    ),
    "capacity_status": _notes(
        "SELECT count(*) AS stored, count(embedding) AS searchable, count(*) - count(embedding) AS divergence, "
        "count(*) > count(embedding) AS diverged, "
        "CASE WHEN count(*) > count(embedding) THEN 'rows without a vector' ELSE 'ok' END AS status FROM notes"
    ),
    "collection_inventory": _notes(
        "SELECT 'notes' AS name, count(*) AS n, count(embedding) AS embedded FROM notes "
        "UNION ALL SELECT 'talks', count(*), 0 FROM conversations"
    ),
    "upsert": _with(
        NOTES,
        """batch AS (SELECT concat('doc_', doc_id) AS id, text AS document,
             concat('{"wing":"', lang, '","room":"quality ', quality, '"}') AS metadata, lang AS wing,
             concat('quality ', quality) AS room, NULL::VARCHAR AS source_file
           FROM documents JOIN labels USING (doc_id)
           UNION ALL SELECT concat('page_', page_id), html, concat('{"wing":"web","source_file":"', url, '"}'),
             'web', NULL, url FROM pages)""",
    ) + "SELECT *, false AS embedded FROM batch UNION ALL "
    "SELECT id, document, metadata, wing, room, source_file, embedding IS NOT NULL FROM notes "
    "WHERE id NOT IN (SELECT id FROM batch)",
    "upsert_last_wins": _with(NOTES, TALKS)
    + "SELECT id, document, metadata, wing, room, source_file, embedding IS NOT NULL AS embedded FROM notes "
    "UNION ALL SELECT concat('talk_', conv_id), document, metadata, metadata::JSON->>'$.wing', "
    "metadata::JSON->>'$.room', NULL, false FROM talks "
    "QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1",
    "upsert_defaults": "SELECT concat('label_', doc_id) AS id, NULL::VARCHAR AS document, '{}' AS metadata, "
    "NULL::VARCHAR AS wing, NULL::VARCHAR AS room, NULL::VARCHAR AS source_file, false AS embedded FROM labels",
    "update_partial": _with(NOTES)
    + """SELECT n.id, CASE WHEN toxic = 1 THEN NULL ELSE document END AS document,
      CASE WHEN quality IS NULL THEN metadata ELSE concat('{"wing":"labelled","quality":', quality, '}') END AS metadata,
      CASE WHEN quality IS NULL THEN wing ELSE 'labelled' END AS wing,
      CASE WHEN quality IS NULL THEN room END AS room,
      CASE WHEN quality IS NULL THEN source_file END AS source_file, embedding IS NOT NULL AND coalesce(toxic, 0) <> 1 AS embedded
    FROM notes n LEFT JOIN labels l ON n.id = concat('doc_', l.doc_id)""",
    "upsert_buckets": _with(NOTES)
    + """SELECT n.id, CASE WHEN toxic = 1 THEN concat('withheld ', quality) ELSE document END AS document,
      CASE WHEN toxic = 1 THEN '{"wing":"withheld"}' ELSE metadata END AS metadata,
      CASE WHEN toxic = 1 THEN 'withheld' ELSE wing END AS wing, CASE WHEN toxic = 1 THEN NULL ELSE room END AS room,
      CASE WHEN toxic = 1 THEN NULL ELSE source_file END AS source_file, embedding IS NOT NULL AND coalesce(toxic, 0) <> 1 AS embedded
    FROM notes n LEFT JOIN labels l ON n.id = concat('doc_', l.doc_id) WHERE NOT (coalesce(toxic, 0) = 1 AND coalesce(quality, 1) = 0)""",
    "upsert_embedded": _with(
        NOTES, "texts AS (SELECT concat('copy_', doc_id) AS id, text FROM documents)", _hashed("vectors", "texts")
    ) + f"""SELECT id, 'copy' AS wing, {TOTAL.format('embedding')} FROM vectors
      UNION ALL SELECT id, wing, {TOTAL.format('embedding')} FROM notes WHERE embedding IS NOT NULL""",
    "update_reembedded": _with(
        NOTES,
        """texts AS (SELECT n.id, concat('withheld, quality ', quality) AS text
          FROM notes n JOIN labels l ON n.id = concat('doc_', l.doc_id) WHERE toxic = 1)""",
        _hashed("vectors", "texts"),
    ) + f"""SELECT id, text AS document, 'labelled' AS wing, {TOTAL.format('embedding')} FROM vectors JOIN texts USING (id)
      UNION ALL SELECT n.id, document, CASE WHEN l.doc_id IS NULL THEN wing ELSE 'labelled' END, {TOTAL.format('embedding')}
      FROM notes n LEFT JOIN labels l ON n.id = concat('doc_', l.doc_id) WHERE embedding IS NOT NULL AND coalesce(toxic, 0) <> 1""",
    "delete_ids": _notes(
        "SELECT id, metadata FROM notes WHERE id NOT IN (SELECT concat('doc_', doc_id) FROM labels WHERE toxic = 1)"
    ),
    "delete_id_list": _notes("SELECT id, metadata FROM notes WHERE id NOT IN ('doc_1', 'doc_3')"),
    "delete_nothing": _notes("SELECT id, metadata FROM notes"),
    "delete_where": _notes("SELECT id, metadata FROM notes WHERE room IS NULL OR room <> 'src3'"),
    "quarantine": _with(MIXED) + "SELECT * FROM bad",
    "quarantine_counts": _with(MIXED) + 'SELECT "table", count(*) AS skipped FROM bad GROUP BY 1',
    "quarantine_cut_lines": """WITH lines AS (SELECT doc_id, toxic, quality, concat('{"id":"doc_', doc_id, '","document":"text"',
        CASE WHEN quality = 0 THEN ',"embedding":7' ELSE '' END, CASE WHEN toxic = 1 THEN '' ELSE '}' END) AS raw
      FROM labels)
    SELECT 'line is not a readable row' AS error, raw FROM lines WHERE toxic = 1 OR quality = 0
    UNION ALL SELECT 'kept', raw FROM lines WHERE toxic = 1 OR quality = 0
    UNION ALL SELECT 'filed', concat('doc_', doc_id) FROM lines WHERE toxic <> 1 AND quality <> 0""",
    "remine_candidates": _with(MIXED)
    + "SELECT id, max(source_file) AS source_file, max(room) AS room, count(*) AS attempts FROM bad "
    "WHERE id NOT IN (SELECT url FROM pages) GROUP BY id",
    "cosine_distance": _with(PROTOTYPES)
    + "SELECT vec_id, round(round(list_cosine_distance(e.embedding::DOUBLE[], q.embedding), 9), 6) AS distance "
    "FROM embeddings e JOIN prototypes q ON label = query_id",
    "knn_single": _knn("", queries="centre", views=(NOTES, CENTRE)),
    "knn_batch": _knn(", document, metadata"),
    "knn_filtered": _knn(", document, metadata", where="AND wing = 'en'"),
    "knn_blocked": _knn(""),
    "knn_text": _knn(
        "", rows="embedded", queries="asked",
        views=(
            "texts AS (SELECT concat('doc_', doc_id) AS id, text FROM documents)",
            "items AS (SELECT item_id AS id, text FROM benchmark)",
            _hashed("vectors", "texts"),
            _hashed("queried", "items"),
            "asked AS (SELECT id AS query_id, embedding FROM queried)",
            "embedded AS (SELECT id, embedding, NULL AS document, NULL AS metadata FROM vectors)",
        ),
    ),
    "query_nested_result": _with(NOTES, PROTOTYPES, KNN.format(rows="notes", queries="prototypes", where=""))
    + "SELECT query_id, string_agg(id, '|' ORDER BY rank) AS ids, round(sum(distance), 6) AS total "
    "FROM hits GROUP BY query_id",
    "embed_documents": _with(
        "texts AS (SELECT concat('doc_', doc_id) AS id, text FROM documents)", _hashed("vectors", "texts")
    ) + f"SELECT id, {TOTAL.format('embedding')} FROM vectors",
    "mean_pool": """SELECT vec_id, len(v) AS n, round(list_sum(list_transform(v, lambda x, i: i * x / s)), 6) AS total FROM (
      SELECT vec_id, v, coalesce(nullif(sqrt(list_sum(list_transform(v, lambda x: x * x))), 0), 1) AS s FROM (
        SELECT vec_id, list_transform(range(1, 9), lambda d: coalesce(list_sum(list_transform(
            list_filter(range(8), lambda i: embedding[i * 8 + 1] > 0),
            lambda i: embedding[i * 8 + d]::DOUBLE)), 0)
          / greatest(len(list_filter(range(8), lambda i: embedding[i * 8 + 1] > 0)), 1)) AS v
        FROM embeddings))""",
    "embedding_parity": _with(PROTOTYPES)
    + """SELECT count(*) AS pairs, round(min(c), 6) AS min_cosine, round(avg(c), 6) AS avg_cosine,
      round(max(c), 6) AS max_cosine FROM (
        SELECT 1 - list_cosine_distance(e.embedding::DOUBLE[], q.embedding) AS c
        FROM embeddings e JOIN prototypes q ON label = query_id)""",
    "export_rows": _notes("SELECT id, document, metadata, len(embedding) AS n FROM notes"),
    "backup_manifest": """SELECT 'notes' AS "table", count(*) AS rows,
      'id,document,metadata,embedding,wing,room,source_file' AS columns, 'embedding' AS vector_columns,
      '20260101-000000Z' AS created FROM documents
    UNION ALL SELECT 'talks', count(*), 'id,document,metadata', '', '20260101-000000Z' FROM conversations
    UNION ALL SELECT 'triples', count(*), 'id,subject,predicate,object,valid_from,valid_to,confidence,'
      || 'source_closet,source_file,source_drawer_id,adapter_name,extracted_at', '', '20260101-000000Z'
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey""",
    "restore_dry_run": _with(PURCHASES)
    + """SELECT 'notes' AS "table", count(*) AS backup_rows, count(*) FILTER (WHERE lang <> 'de') AS current_rows
      FROM documents
    UNION ALL SELECT 'talks', count(*), count(*) FROM conversations
    UNION ALL SELECT 'triples', count(*), NULL FROM purchases
    UNION ALL SELECT 'pages', NULL, count(*) FROM pages""",
    "restore_roundtrip": _notes(
        f"SELECT id, document, metadata, wing, room, source_file, {TOTAL.format('embedding')} FROM notes"
    ),
    "ingest_discover": _with(MANIFEST) + "SELECT path, 'pending' AS status, mtime FROM manifest WHERE status <> 'done'",
    "ingest_status": _with(MANIFEST)
    + """SELECT *, total - done AS pending, 30.0::DOUBLE AS files_per_minute,
      (total - done) / 0.5 / 3600 AS eta_hours FROM (
        SELECT count(*) FILTER (WHERE status = 'done') AS done, count(*) AS total,
          coalesce(sum(drawers) FILTER (WHERE status = 'done'), 0)::BIGINT AS drawers FROM manifest)""",
    "already_mined": _notes(
        "SELECT DISTINCT source_file FROM notes WHERE source_file IN (SELECT source_file FROM notes "
        "WHERE room IS NULL AND id IN (SELECT concat('doc_', doc_id) FROM labels))"
    ),
    # facts
    "entity_scan": _with(ENTITIES) + "SELECT id, name, type, created FROM entities",
    "kg_slug": """SELECT DISTINCT name, replace(replace(lower(name), ' ', '_'), '''', '') AS entity,
      replace(lower(name), ' ', '_') AS predicate, upper(name[1]) || lower(name[2:]) AS capitalized FROM (
        SELECT 'O''' || c_name AS name FROM customer UNION ALL SELECT 'O''' || p_name FROM part)""",
    "kg_temporal_keys": _with(TRIPLES)
    + f'SELECT id, {_start("valid_from")} AS start, {_end("valid_to")} AS "end" FROM triples',
    "kg_as_of": _with(TRIPLES)
    + f"SELECT predicate, count(*) AS n FROM triples WHERE {_valid(_quoted_key(AS_OF))} GROUP BY 1",
    "kg_current": _with(TRIPLES)
    + "SELECT predicate, valid_to IS NULL AS current, count(*) AS n FROM triples GROUP BY 1, 2",
    "kg_entity_out": _entity(CUSTOMER, ["outgoing"]),
    "kg_entity_in": _entity(PART, ["incoming"]),
    "kg_entity_both": _entity(CUSTOMER, ["outgoing", "incoming"], AS_OF),
    "kg_relationship": _facts(f"SELECT {NAMED} WHERE predicate = 'sent_back'"),
    "kg_relationship_as_of": _facts(
        f"SELECT {NAMED} WHERE predicate = 'sent_back' AND {_valid(_quoted_key(AS_OF))}"
    ),
    "kg_timeline_entity": _timeline(
        f"WHERE t.subject = '{CUSTOMER.lower()}' OR t.object = '{CUSTOMER.lower()}'"
    ),
    "kg_timeline_all": _timeline(),
    "kg_as_of_batch": _facts(
        f"""SELECT c_name AS subject, as_of, predicate, name AS object, {SHOWN}
        FROM (SELECT c_name, unnest(['1996-01-01', '1998-06-01', '2000-06-01']) AS as_of FROM customer)
        JOIN triples t ON t.subject_name = c_name JOIN entities e ON t.object = e.id
        WHERE {_valid("(as_of || 'T00:00:00Z')")}"""
    ),
    "kg_as_of_hot": _facts(
        f"""SELECT direction, predicate, as_of, count(*) AS n, CAST(sum(confidence) AS DECIMAL(18, 2)) AS confidence FROM (
        SELECT 'outgoing' AS direction, t.*, t.subject_name AS asked, t.object AS other FROM triples t
        UNION ALL SELECT 'incoming', t.*, t.object_name, t.subject FROM triples t) t
        JOIN (SELECT name, strftime(unnest(generate_series(DATE '1992-01-01', DATE '1999-12-01', INTERVAL 1 MONTH)), '%Y-%m-%d') AS as_of
          FROM (SELECT c_name AS name FROM customer UNION ALL SELECT DISTINCT p_name FROM part)) p ON t.asked = p.name
        JOIN entities e ON t.other = e.id
        WHERE {_valid("(as_of || 'T00:00:00Z')")} GROUP BY ALL"""
    ),
    "kg_stats": _facts(
        "SELECT (SELECT count(*) FROM entities) AS entities, count(*) AS triples, "
        "count(*) FILTER (WHERE valid_to IS NULL) AS current_facts, "
        "count(*) FILTER (WHERE valid_to IS NOT NULL) AS expired_facts, "
        "count(DISTINCT predicate) AS relationship_kinds FROM triples"
    ),
    "kg_predicates": _with(TRIPLES) + "SELECT DISTINCT predicate FROM triples ORDER BY 1",
    "kg_add_triples": _with(PURCHASES, _added("purchases"))
    + f"SELECT {STORED} FROM (SELECT *, new_id AS id FROM added WHERE met IS NULL)",
    "kg_add_triples_provenance": _with(PURCHASES, _added("purchases"))
    + f"""SELECT new_id AS id, source_closet, NULL::VARCHAR AS source_file, NULL::VARCHAR AS source_drawer_id, adapter_name,
      '{BATCH_TS[:10]}' AS extracted FROM added WHERE met IS NULL""",
    "kg_add_triples_later": LATER,
    "kg_triple_id": _with(PURCHASES) + f"SELECT seq, {_fact_id(BATCH_TS)} AS id FROM purchases",
    "kg_inverted_rejects": _with(PURCHASES)
    + f"""SELECT seq, 'the interval ends before it starts' AS reason FROM purchases
      WHERE strftime(o_orderdate + to_days(60), '%Y-%m-%d') || 'T23:59:59Z' < {_start('valid_from')}""",
    "kg_upsert_entities": _with(CUSTOMERS)
    + f"""SELECT c.id, name, CASE WHEN p IS NULL THEN type ELSE 'buyer' END AS type,
        CASE WHEN p IS NOT NULL THEN concat('{{"priority":"', p, '"}}') END AS properties, created
      FROM customers c LEFT JOIN (SELECT c_name, max_by(o_orderpriority, o_orderkey) AS p
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) ON c_name = name
      UNION ALL SELECT replace(replace(lower(s_name), ' ', '_'), '''', ''), s_name, 'unknown', '{{}}',
        '{BATCH_TS[:10]}' FROM supplier""",
    "kg_implicit_entities": _with(CUSTOMERS, PURCHASES)
    + f"""SELECT id, name, type, NULL::VARCHAR AS properties, created FROM customers
      UNION ALL SELECT DISTINCT object, object_name, 'unknown', NULL, '{BATCH_TS[:10]}' FROM purchases""",
    "kg_invalidate": _with(*INVALIDATION)
    + """SELECT id, s.subject, s.predicate, s.object, valid_from, c.ended AS valid_to, confidence
      FROM store s LEFT JOIN closing c ON s.subject = c.subject AND s.predicate = c.predicate
        AND s.object = c.object""",
    "kg_invalidate_rejects": _with(*INVALIDATION)
    + """SELECT t.seq, t.subject, t.predicate, t.object, t.ended, 'the interval ends before it starts' AS reason
      FROM tried t LEFT JOIN closing c ON t.subject = c.subject AND t.predicate = c.predicate
        AND t.object = c.object WHERE late AND (closed_at IS NULL OR t.seq < closed_at)""",
    "kg_apply_events": f"""WITH RECURSIVE {JUDGED}
      SELECT seq, kind, status, fact_id,
        CASE WHEN status = 'rejected' THEN 'the interval ends before it starts' END AS reason FROM judged""",
    "kg_apply_events_sparse": f"""WITH RECURSIVE {SPARSE_JUDGED}
      SELECT seq, kind, status, fact_id,
        CASE WHEN status = 'rejected' THEN 'the interval ends before it starts' END AS reason FROM judged WHERE seq IS NOT NULL""",
    "kg_events_sparse_triples": f"""WITH RECURSIVE {SPARSE_JUDGED}, closings AS (SELECT fact_id, ended FROM judged WHERE status = 'closed')
      SELECT j.fact_id AS id, subject, valid_from, coalesce(valid_to, c.ended) AS valid_to
      FROM judged j JOIN checked USING (seq) LEFT JOIN closings c ON j.fact_id = c.fact_id WHERE j.status = 'inserted'
      UNION ALL SELECT s.id, s.subject, s.valid_from, coalesce(s.valid_to, c.ended)
      FROM stored s LEFT JOIN entered e ON s.subject = e.subject LEFT JOIN closings c ON c.fact_id = e.id""",
    "kg_events_triples": f"""WITH RECURSIVE {JUDGED}
      SELECT j.fact_id AS id, subject, valid_from, coalesce(valid_to, c.ended) AS valid_to
      FROM judged j JOIN checked USING (seq) LEFT JOIN (SELECT fact_id, ended FROM judged WHERE status = 'closed') c
        ON j.fact_id = c.fact_id WHERE j.status = 'inserted'""",
    "kg_seed_entities": _with(PEOPLE)
    + f"""SELECT replace(replace(lower(name), ' ', '_'), '''', '') AS id, name,
        CASE WHEN segment = 'HOUSEHOLD' THEN 'animal' ELSE type END AS type,
        CASE WHEN segment = 'HOUSEHOLD' THEN '{{}}' ELSE
          concat('{{"gender":"', gender, '","birthday":"', coalesce(birthday, ''), '"}}') END AS properties,
        '{BATCH_TS[:10]}' AS created FROM people
      UNION ALL SELECT object, min_by(other, seq * 10 + step), 'unknown', NULL, '{BATCH_TS[:10]}' FROM slugs
        WHERE object NOT IN (SELECT replace(replace(lower(name), ' ', '_'), '''', '') FROM people) GROUP BY object""",
    "kg_seed_triples": _with(PEOPLE)
    + """SELECT subject, predicate, object, valid_from, NULL::VARCHAR AS valid_to FROM slugs
      QUALIFY row_number() OVER (PARTITION BY subject, predicate, object ORDER BY seq, step) = 1""",
}
