"""SQL of those queries that SQL can express on whole tables."""

from __future__ import annotations



def merkle_sql(levels: int) -> str:
    """Trees of up to ``3 ** levels`` documents a source and as many sources, level by level."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR END"
    leaf = "sha256(" + " || ".join([*(field.format(c) for c in ("doc_id", "source", "lang", "n_chars")), "{}"]) + ")"
    whole, cut = leaf.format(field.format("text")), leaf.format(field.format("replace(text, chr(10), '')"))
    bits = "list_reduce(list_prepend(xor(acc, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda acc, b: {bits}), 4294967295)"
    parts = [f"""
        hashed AS (
            SELECT doc_id, source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {whole} AS leaf,
                   CASE WHEN {crc} % 2 = 0 THEN {cut} ELSE {whole} END AS shown
            FROM documents
        ), docs AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
        ), low0 AS (SELECT tree, place AS idx, leaf AS d FROM docs)"""]

    def grow(name: str) -> str:
        steps = [f"""
        , {name}{k + 1} AS (
            SELECT tree, idx // 3 AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d FROM {name}{k}
            WHERE tree IN (SELECT tree FROM {name}{k} GROUP BY tree HAVING count(*) > 1) GROUP BY ALL
        ), {name}_sides{k} AS (
            SELECT a.tree, a.idx, coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
                   coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
            FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.idx // 3 = b.idx // 3
            WHERE a.tree IN (SELECT tree FROM {name}{k} GROUP BY tree HAVING count(*) > 1) GROUP BY ALL
        )""" for k in range(levels)]
        ends = " UNION ALL ".join(
            f"SELECT tree, any_value(d) AS d FROM {name}{k} GROUP BY tree HAVING count(*) = 1" for k in range(levels + 1)
        )
        return "".join(steps) + f", {name}_ends AS ({ends})"

    def climb(name: str, place: str, before: str) -> str:
        steps = []
        for k in range(levels):
            steps.append(f"""
        , {name}_way{k} AS (
            SELECT f.* REPLACE (
                       CASE WHEN s.l IS NULL THEN h ELSE sha256(s.l || h || s.r) END AS h,
                       proof || coalesce(s.l || s.r, '') AS proof
                   )
            FROM {before} f LEFT JOIN {name}_sides{k} s ON s.tree = {"f.tree" if name == "low" else "0"} AND s.idx = f.{place} // {3**k}
        )""")
            before = f"{name}_way{k}"
        return "".join(steps)

    parts.append(grow("low"))
    parts.append(", high0 AS (SELECT 0 AS tree, tree AS idx, d FROM low_ends)")
    parts.append(grow("high"))
    parts.append(", start AS (SELECT doc_id, tree, place, leaf, shown AS h, '' AS proof FROM docs)")
    parts.append(climb("low", "place", "start"))
    parts.append(climb("high", "tree", f"low_way{levels - 1}"))
    return f"""WITH {"".join(parts)}
        SELECT w.doc_id, w.leaf, e.d AS subroot, t.d AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root,
               w.h = t.d AS verified
        FROM high_way{levels - 1} w JOIN low_ends e ON w.tree = e.tree CROSS JOIN high_ends t
    """


TO_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES: dict[str, str] = {
    # Runs are compared by their whole text.
    "op4_line_runs": r"""
        WITH split AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line
            FROM documents
        ), worded AS (
            SELECT doc_id, line, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
            FROM split WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
        ), numbered AS (
            SELECT *, row_number() OVER w AS n, sum(words) OVER w AS upto FROM worded
            WINDOW w AS (PARTITION BY doc_id ORDER BY line)
        ), ends AS (
            SELECT a.doc_id, a.n AS first, min(b.n) AS last
            FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND b.n BETWEEN a.n AND a.n + 9
            WHERE b.upto - a.upto + a.words >= 10 GROUP BY ALL
            UNION
            SELECT b.doc_id, max(a.n) AS first, b.n AS last
            FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND a.n BETWEEN b.n - 9 AND b.n
            WHERE b.upto - a.upto + a.words >= 10 GROUP BY b.doc_id, b.n
        ), runs AS (
            SELECT e.doc_id, e.first, e.last, string_agg(n.x, chr(10) ORDER BY n.n) AS run
            FROM ends e JOIN numbered n ON e.doc_id = n.doc_id AND n.n BETWEEN e.first AND e.last GROUP BY ALL
        ), later AS (
            SELECT * FROM runs
            QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, first) > 1
        ), gone AS (
            SELECT DISTINCT n.doc_id, n.line FROM numbered n JOIN later l ON n.doc_id = l.doc_id AND n.n BETWEEN l.first AND l.last
        )
        SELECT s.doc_id, count(g.line) AS removed_lines,
               md5(coalesce(string_agg(s.x, chr(10) ORDER BY s.line) FILTER (WHERE g.line IS NULL), '')) AS text_md5
        FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.line = g.line GROUP BY s.doc_id
    """,
    "op5_poisson_mixing": """
        WITH sizes AS (SELECT source, sum(length(coalesce(text, ''))) AS size FROM documents GROUP BY source),
        rates AS (
            SELECT source, (SELECT sum(size) FROM sizes) / (SELECT count(*) FROM sizes WHERE size > 0) / size AS rate
            FROM sizes WHERE size > 0
        ), terms AS (
            SELECT source, k, exp(-rate + CASE WHEN k = 0 THEN 0 ELSE k * ln(rate) END - lgamma(k + 1)) AS p
            FROM rates, range(0, 300) AS r(k)
        ), steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS upto FROM terms),
        drawn AS (
            SELECT doc_id, source, text,
                   ('0x' || substr(md5('17:0:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u
            FROM documents
        ), counted AS (
            SELECT d.doc_id, d.source, d.text, min(s.k) AS copies
            FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.upto > d.u GROUP BY ALL
        )
        SELECT doc_id, source, unnest(range(0, copies)) AS copy, md5(coalesce(text, '')) AS text_md5 FROM counted
    """,
    # The lengths follow from the template: marks of a turn, and two characters for each escape.
    "op6_chat_tree": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), sized AS (
            SELECT *, length(role) + length(text) + 24
                + length(text) - length(replace(text, '\', ''))
                + 2 * len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<\|startoftext\|>|</?s>|\[/?INST\]|<</?SYS>>'))
                AS chars
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
    "op7_warc_source": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op11_merkle_proofs": merkle_sql(9),
    # Every window of a document is compared as text.
    "op12_phrase_index": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   coalesce(regexp_extract_all(translate(text, {TO_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(text, {TO_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size,
                   array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
        ), spans AS (
            SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
            FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM windows))
        ), hits AS (SELECT r, i, s.size, item_id FROM spans s JOIN windows v ON s.size = v.size AND s.words = v.words),
        covered AS (
            SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r
        ), listed AS (
            SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM hits GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(l.n, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, c.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN covered c USING (r) LEFT JOIN listed l USING (r)
    """,
    # Every pair of sources is compared in every term.
    "op13_spimi_divergence": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), {TO_LOWER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), found AS (
            SELECT lang, source, r, term, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL
        ), terms AS (SELECT lang, term, sum(n) AS n FROM found GROUP BY ALL HAVING count(*) >= 3),
        places AS (SELECT DISTINCT lang, source FROM d),
        counts AS (
            SELECT p.lang, p.source, t.term, t.n AS lang_n, coalesce(sum(f.n), 0) AS n
            FROM places p JOIN terms t ON p.lang = t.lang
            LEFT JOIN found f ON f.lang = p.lang AND f.source = p.source AND f.term = t.term GROUP BY ALL
        ), shares AS (
            SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER g + count(*) OVER g) AS p,
                   1 + (1000000000::HUGEINT * (lang_n + 1)) // (sum(lang_n) OVER g + count(*) OVER g) AS q
            FROM counts WINDOW g AS (PARTITION BY lang, source)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), every AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
            FROM places a JOIN places b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::BIGINT AS value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM every QUALIFY part = 'pair' OR rank <= 200
    """,
}
