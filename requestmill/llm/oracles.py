"""DuckDB SQL of the operators that SQL can express, with their numbers written out."""

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

TOKEN_ROLLUP = rf"""
WITH d AS (SELECT source, lang, coalesce(text, '') AS t, split_part(coalesce(text, ''), chr(10), 1) AS f
           FROM documents),
c AS (SELECT source, lang, length(t) AS chars, greatest(length(t) - length(f) - 1, 0) AS rest_chars,
             len({_WORDS.format('t')}) AS words, len({_WORDS.format('f')}) AS first_words,
             len(regexp_extract_all(t,
               '[A-Za-z]+|[0-9]|[^\x{{00}}-\x{{7F}}]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) AS pieces
      FROM d),
kept AS (SELECT * FROM c WHERE words >= 10)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs,
       CAST(sum(words - first_words) AS BIGINT) AS n_tokens,
       CAST(sum(rest_chars) AS BIGINT) AS n_chars
FROM kept GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces-1', count(*), CAST(sum(pieces) AS BIGINT), CAST(sum(chars) AS BIGINT)
FROM kept GROUP BY source, lang
"""

_COMMON = (
    "the of and to in is that for it with on are "
    "der die und das den von zu mit ist des nicht ein "
    "le la les de et du une est pour que dans "
    "el los las y en un por con no se lo para"
).split()
_BINS = ", ".join(f"('w', '{w}')" for w in [*dict.fromkeys(_COMMON), "~"])
_CLASS_BINS = ", ".join(f"('c', '{k}')" for k in range(7))


def _round(n: int, passing: str) -> str:
    """References over the passing rows, and all rows' distances from them."""
    return f"""
ref{n} AS (SELECT b.lang, h.kind, h.bin, sum(h.n) AS n FROM base b JOIN hist h USING (rid)
           WHERE b.lang IS NOT NULL AND {passing} GROUP BY ALL),
q{n} AS (SELECT lang, kind, bin, n / sum(n) OVER (PARTITION BY lang, kind) AS q FROM ref{n}),
s{n} AS (SELECT b.rid, a.kind, coalesce(p.p, 0) AS p, coalesce(r.q, 0) AS q
         FROM base b CROSS JOIN bins a
         LEFT JOIN share p ON p.rid = b.rid AND p.kind = a.kind AND p.bin = a.bin
         LEFT JOIN q{n} r ON r.lang = b.lang AND r.kind = a.kind AND r.bin = a.bin),
j{n} AS (SELECT rid, kind, CASE WHEN sum(p) > 0 AND sum(q) > 0 THEN sqrt(greatest(0, sum(
           CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END +
           CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) ELSE 0 END AS d
         FROM s{n} GROUP BY rid, kind),
d{n} AS (SELECT b.rid, c.d AS cd, w.d AS wd,
           (b.chars >= 200 AND c.d > 0.15 + 0.8 / sqrt(b.chars))
           OR (b.n_words >= 100 AND w.d > 0.26) AS far
         FROM base b JOIN j{n} c ON c.rid = b.rid AND c.kind = 'c'
         JOIN j{n} w ON w.rid = b.rid AND w.kind = 'w')"""


DISTRIBUTION_DIVERGENCE = rf"""
WITH raw AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
x AS (SELECT *, {_WORDS.format('t')} AS w, regexp_replace(t, '[a-z ]+', '', 'g') AS rest FROM raw),
k AS (SELECT *, length(regexp_replace(rest, '[^#*$%&|<>]+', '', 'g')) AS c1,
        length(regexp_replace(rest, '[^A-Z]+', '', 'g')) AS c2,
        length(regexp_replace(rest, '[^0-9]+', '', 'g')) AS c3,
        length(regexp_replace(rest, '[^.,;:''"?()-]+', '', 'g')) AS c4,
        length(regexp_replace(rest, '[\x{{00}}-\x{{7F}}]+', '', 'g')) AS c5 FROM x),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM raw),
dup AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM lines
        WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
starts AS (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM x),
grams AS (SELECT rid, i, array_to_string(array_slice(w, i, i + 4), ' ') AS g FROM starts),
twice AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams),
hit AS (SELECT DISTINCT rid, unnest(range(i, i + 5)) AS i FROM twice WHERE n > 1),
rep AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid),
base AS (SELECT k.rid, doc_id, lang, length(t) AS chars, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, c1 AS n_symbols,
           coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
           len(w) < 10 OR 100 * coalesce(rep.n, 0) > 20 * len(w) AS base_failed
         FROM k LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)),
bins AS (SELECT * FROM (VALUES {_CLASS_BINS}, {_BINS}) AS v(kind, bin)),
counts AS (SELECT rid, [length(t) - length(rest), c1, c2, c3, c4, c5,
             length(rest) - c1 - c2 - c3 - c4 - c5] AS c FROM k),
places AS (SELECT rid, c, unnest(range(0, 7)) AS i FROM counts),
tokens AS (SELECT rid, unnest(w) AS word FROM x),
hist AS (SELECT rid, 'c' AS kind, CAST(i AS VARCHAR) AS bin, c[i + 1] AS n FROM places
         UNION ALL
         SELECT rid, 'w', CASE WHEN v.bin IS NULL THEN '~' ELSE word END, count(*)
         FROM tokens LEFT JOIN (SELECT bin FROM bins WHERE kind = 'w' AND bin <> '~') v
           ON v.bin = word GROUP BY ALL),
share AS (SELECT rid, kind, bin, n / nullif(sum(n) OVER (PARTITION BY rid, kind), 0) AS p FROM hist),
{_round(1, "NOT b.base_failed")},
{_round(2, "NOT b.base_failed AND b.rid NOT IN (SELECT rid FROM d1 WHERE far)")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(cd, 6) AS class_distance, round(wd, 6) AS word_distance, NOT base_failed AND NOT far AS kept
FROM base JOIN d2 USING (rid)
"""

_NORMAL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"
)

DECONTAMINATION = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_NORMAL} AS w FROM benchmark),
bs AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
       FROM b WHERE len(w) > 0),
bg AS (SELECT DISTINCT item, size, array_to_string(array_slice(w, i, i + size - 1), ' ') AS g FROM bs),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_NORMAL} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM bg),
ds AS (SELECT rid, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d CROSS JOIN sizes),
dg AS (SELECT rid, size, i, array_to_string(array_slice(w, i, i + size - 1), ' ') AS g FROM ds),
h AS (SELECT rid, item, i, dg.size FROM dg JOIN bg ON dg.size = bg.size AND dg.g = bg.g),
cover AS (SELECT DISTINCT rid, unnest(range(i, i + size)) AS i FROM h),
hits AS (SELECT rid, count(*) AS n FROM cover GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l
          FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit,
       coalesce(items.n, 0) AS n_items, sha256(coalesce(items.l, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

_DIGITS = "'0123456789abcdef'"
_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"


def _base32(digits: str) -> str:
    """Five bits at a time, from a bit string of a hexadecimal one."""
    bits = (
        f"array_to_string(list_transform(string_split({digits}, ''), "
        f"lambda c: lpad(bin(strpos({_DIGITS}, c) - 1), 4, '0')), '')"
    )
    five = " + ".join(f"{1 << 4 - k} * CAST(substr(b, 5 * i + {k + 1}, 1) AS INT)" for k in range(5))
    return (
        f"array_to_string(list_transform(range(0, 32), lambda i: "
        f"substr({_BASE32}, {five.replace('b,', bits + ',')} + 1, 1)), '')"
    )


WARC_ARCHIVE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, t, sha1(t) AS s, max(page_id) OVER (PARTITION BY t) AS first FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, {_base32("s")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""


def _crc_table() -> str:
    def entry(k: int) -> int:
        for _ in range(8):
            k = (k >> 1) ^ (0xEDB88320 if k & 1 else 0)
        return k

    return "[" + ", ".join(str(entry(k)) for k in range(256)) + "]::BIGINT[]"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return f"sha256({' || '.join(map(_field, fields))})"


# Levels of all language trees at once, then of the tree of their roots; a node's sibling is its
# neighbour in the pair. Proofs and folds climb one level a step.
MERKLE_MANIFEST = f"""
WITH RECURSIVE tbl AS (SELECT {_crc_table()} AS t),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
        CASE WHEN xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0
             THEN {_leaf("(n_chars + 1)")} END AS altered
      FROM documents, tbl),
places AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
low AS (SELECT 0 AS level, tree, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM places
        UNION ALL
        SELECT level + 1, tree, pos // 2, sha256(h || coalesce(after, '')), (n + 1) // 2
        FROM (SELECT *, lead(h) OVER (PARTITION BY tree ORDER BY pos) AS after FROM low WHERE n > 1)
        WHERE pos % 2 = 0),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM low WHERE n = 1),
high AS (SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM subroots
         UNION ALL
         SELECT level + 1, pos // 2, sha256(h || coalesce(after, '')), (n + 1) // 2
         FROM (SELECT *, lead(h) OVER (ORDER BY pos) AS after FROM high WHERE n > 1)
         WHERE pos % 2 = 0),
climb AS (SELECT rid, p.tree, 0 AS level, pos, coalesce(altered, leaf) AS h, '' AS proof FROM places p
          UNION ALL
          SELECT rid, c.tree, c.level + 1, c.pos // 2,
                 sha256(CASE WHEN c.pos % 2 = 0 THEN c.h || coalesce(s.h, '') ELSE s.h || c.h END),
                 c.proof || coalesce(s.h, '')
          FROM climb c JOIN (SELECT tree, level FROM low WHERE n > 1 AND pos = 0) l
            ON l.tree = c.tree AND l.level = c.level
          LEFT JOIN low s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)),
up AS (SELECT rid, 0 AS level, s.pos, c.h, proof FROM climb c JOIN (SELECT tree, level FROM low WHERE n = 1) l
         ON l.tree = c.tree AND l.level = c.level JOIN subroots s ON s.tree = c.tree
       UNION ALL
       SELECT rid, c.level + 1, c.pos // 2,
              sha256(CASE WHEN c.pos % 2 = 0 THEN c.h || coalesce(s.h, '') ELSE s.h || c.h END),
              c.proof || coalesce(s.h, '')
       FROM up c JOIN (SELECT level FROM high WHERE n > 1 AND pos = 0) l ON l.level = c.level
       LEFT JOIN high s ON s.level = c.level AND s.pos = xor(c.pos, 1)),
ends AS (SELECT rid, h, proof FROM up WHERE level = (SELECT max(level) FROM high))
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM places JOIN ends e USING (rid) JOIN subroots USING (tree), (SELECT h FROM high WHERE n = 1) r
"""

ORACLES = {
    "op1_token_count_rollup": TOKEN_ROLLUP,
    "op2_distribution_divergence": DISTRIBUTION_DIVERGENCE,
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op11_warc_archive": WARC_ARCHIVE,
    "op12_merkle_manifest": MERKLE_MANIFEST,
}
