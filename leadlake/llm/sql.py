"""SQL that states the same results plainly, for another engine. Patterns are written out here and not taken from the operators."""

from __future__ import annotations


def _spans(name: str, pattern: str) -> str:
    """Two columns for a kind: the text between its matches, and the matches."""
    return f"string_split_regex(t, '{pattern}') AS g_{name}, regexp_extract_all(t, '{pattern}') AS h_{name}"


def _placed(name: str, rank: int, keep: str = "true") -> str:
    """The kept matches of a kind as {s, r, e, k, h}: start, rank, end, kind, match. `keep` is a condition on x.h and x.s."""
    start = f"list_sum(list_transform(g_{name}[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(h_{name}[1:i - 1], lambda z: length(z))), 0)"
    placed = f"list_transform(range(1, len(h_{name}) + 1), lambda i: {{'s': CAST({start} AS BIGINT), 'h': h_{name}[i]}})"
    return f"list_transform(list_filter({placed}, lambda x: {keep}), lambda x: {{'s': x.s, 'r': {rank}, 'e': CAST(x.s + length(x.h) AS BIGINT), 'k': '{name}'}})"


def _written(spans: str) -> str:
    return f"array_to_string(list_transform(list_sort({spans}), lambda x: x.k || ':' || x.s || ':' || x.e), ',')"


def _count(kind: str) -> str:
    return f"CAST(len(list_filter(base, lambda x: x.k = '{kind}')) AS BIGINT) AS n_{kind}"


_DIGITS = "regexp_replace(x.h, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS})[i] AS INT) "
         f"WHEN CAST(reverse({_DIGITS})[i] AS INT) > 4 THEN 2 * CAST(reverse({_DIGITS})[i] AS INT) - 9 ELSE 2 * CAST(reverse({_DIGITS})[i] AS INT) END)) % 10 = 0")
_TURNED = "substr(replace(x.h, ' ', ''), 5) || substr(replace(x.h, ' ', ''), 1, 4)"
_MOD97 = (f"list_reduce(list_transform(string_split({_TURNED}, ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END), "
          "lambda a, d: CASE WHEN d >= 10 THEN (a * 100 + d) % 97 ELSE (a * 10 + d) % 97 END, 0) = 1")
_ID_CONTEXT = r"\bssn\b|social security|national id|sozialversicherung|seguridad social"

PII = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS (SELECT doc_id, t,
  {_spans('email', r'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')},
  {_spans('ip', r'[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)')},
  {_spans('card', '[0-9](?:[ -]?[0-9])+')},
  {_spans('phone', r'\+[0-9][ ().0-9-]+[0-9]')},
  {_spans('iban', r'\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b')},
  {_spans('national_id', r'\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b')} FROM texts),
found AS (SELECT doc_id, t,
  {_placed('email', 0)} || {_placed('ip', 1, "list_bool_and(list_transform(string_split(x.h, '.'), lambda p: length(ltrim(p, '0')) < 4 AND CAST('0' || right(p, 3) AS INT) <= 255))")}
  || {_placed('card', 2, f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}")} || {_placed('phone', 3, f"length({_DIGITS}) BETWEEN 10 AND 15")} AS base,
  {_placed('iban', 4, _MOD97)} || {_placed('national_id', 5, f"regexp_matches(lower(substr(t, greatest(x.s - 48, 0) + 1, x.s - greatest(x.s - 48, 0))), '{_ID_CONTEXT}')")} AS more FROM cut)
SELECT doc_id, {_count('email')}, {_count('ip')}, {_count('card')}, {_count('phone')}, sha256({_written('base')}) AS base_sha256, {_written('base || more')} AS spans FROM found
"""

_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS (SELECT doc_id, {_spans('assign', _ASSIGN)}, {_spans('access', 'AKIA[A-Z0-9]+')}, {_spans('hex', '[0-9a-f]{16,}')},
  {_spans('code_host_token', 'gh[pousr]_[A-Za-z0-9]{36,}')}, {_spans('chat_token', 'xox[abprs]-[A-Za-z0-9-]{10,}')},
  {_spans('private_key', '-----BEGIN [A-Z ]*PRIVATE KEY-----')}, {_spans('signed_token', r'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}')},
  {_spans('payment_key', 'sk_live_[A-Za-z0-9]{16,}')} FROM texts),
found AS (SELECT doc_id,
  {_placed('assign', 0, f"length(regexp_extract(x.h, '{_ASSIGN}', 2)) >= 12")} || {_placed('access', 1, 'length(x.h) >= 18')} || {_placed('hex', 2)} AS base,
  {_placed('code_host_token', 3)} || {_placed('chat_token', 4)} || {_placed('private_key', 5)} || {_placed('signed_token', 6)} || {_placed('payment_key', 7)} AS more FROM cut)
SELECT doc_id, {_count('assign')}, {_count('access')}, {_count('hex')}, sha256({_written('base')}) AS base_sha256, {_written('base || more')} AS spans FROM found
"""


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
i AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_words('text')} AS w FROM benchmark) WHERE len(w) > 0),
item_runs AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS run FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM i)),
doc_runs AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS run FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM i))),
hits AS (SELECT doc_id, s, n, item_id FROM doc_runs JOIN item_runs USING (run, n)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def _sized(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({_sized('doc_id')} || {_sized('source')} || {_sized('lang')} || {_sized('n_chars')} || {_sized(text)})"


def _levels(name: str, rows: str) -> str:
    """Nodes level by level, from rows (tree, lvl, pos, n, digest), n being the number of nodes of the tree's level."""
    return (f"{name} AS ({rows} UNION ALL SELECT tree, lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) "
            f"FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 16, n)")


def _climb(name: str, rows: str) -> str:
    """The way up, from rows (id, tree, lvl, pos, cur, sib): the digest so far and the siblings so far."""
    others = "array_to_string(run[1 : pos % 16], '')", "array_to_string(run[pos % 16 + 2 : ], '')"
    return (f"{name} AS ({rows} UNION ALL SELECT id, c.tree, c.lvl + 1, pos // 16, sha256({others[0]} || cur || {others[1]}), sib || {others[0]} || {others[1]} "
            f"FROM {name} c JOIN runs r ON r.tree = c.tree AND r.lvl = c.lvl AND r.up = pos // 16)")


_CRC32 = ("xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
          "lambda a, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, b)), 4294967295), 4294967295)")

MERKLE = f"""
WITH RECURSIVE leaves AS (SELECT row_number() OVER () AS id, doc_id, source, {_leaf('text')} AS leaf,
  CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf('text')} END AS begun FROM documents),
placed AS (SELECT *, CAST(dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS BIGINT) AS tree, CAST(count(*) OVER (PARTITION BY source) AS BIGINT) AS n,
  CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS pos FROM leaves),
{_levels('inside', 'SELECT tree, 0 AS lvl, pos, n, leaf AS digest FROM placed')},
{_levels('above', 'SELECT CAST(-1 AS BIGINT) AS tree, 0 AS lvl, tree AS pos, CAST(count(*) OVER () AS BIGINT) AS n, digest FROM inside WHERE n = 1')},
runs AS (SELECT tree, lvl, pos // 16 AS up, list(digest ORDER BY pos) AS run FROM (SELECT * FROM inside UNION ALL SELECT * FROM above) WHERE n > 1 GROUP BY ALL),
{_climb('low', "SELECT id, tree, 0 AS lvl, pos, begun AS cur, '' AS sib FROM placed")},
{_climb('high', 'SELECT id, CAST(-1 AS BIGINT) AS tree, 0 AS lvl, l.tree AS pos, cur, sib FROM low l JOIN inside s ON s.tree = l.tree AND s.lvl = l.lvl AND s.n = 1')}
SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(h.sib) AS proof_sha256, h.cur AS folded_root, h.cur = t.digest AS verified
FROM placed p JOIN inside s ON s.tree = p.tree AND s.n = 1 JOIN above t ON t.n = 1 JOIN high h ON h.id = p.id AND h.lvl = t.lvl
"""

_SAID = "<|im_end|><|im_start|>assistant ok"
_FORMATTED = "length(replace(role, '<|', '<||')) + 5 * (length(role) - length(replace(role, chr(10), ''))) + length(replace(text, '<|', '<||')) + 24"

CHAT = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_SAID}' UNION ALL SELECT -1, 1, 'assistant', '{_SAID}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_FORMATTED}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

CHECKS: dict[str, str] = {"op1_pii": PII, "op3_secrets": SECRETS, "op7_decontamination": DECONTAMINATION, "op11_merkle": MERKLE, "op13_chat": CHAT}
