"""The registered queries as SQL for DuckDB, written on its own functions.

Its patterns know no look-around and no back-reference, so bracket groups are taken apart and put
together again, and repeated characters are compared. A bare ISBN, which no digit may touch, is a
pattern of its own that takes in its neighbours.
"""

from __future__ import annotations

from ..functions import vocab as V
from . import adapter


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BARE = rf"97[89]{V.D}{{10}}"
OTHER_JUNK = V.JUNK.replace(rf"(?<!{V.D}){_BARE}(?!{V.D})|", "")
JUNK = rf"{OTHER_JUNK}|(?:^|\P{{Nd}}){_BARE}(?:$|\P{{Nd}})"
LETTERS = V.FULL_WIDTH + V.SPACES, V.ASCII + " " * len(V.SPACES)


def squash(x: str) -> str:
    return f"trim(regexp_replace(translate(coalesce({x}, ''), {q(LETTERS[0])}, {q(LETTERS[1])}), {q(V.S + '+')}, ' ', 'g'))"


def sub(x: str, pattern: str, to: str, every: bool = True) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}{', ' + q('g') if every else ''})"


def unwrap(x: str) -> str:
    once = f"trim({sub(squash(x), V.WRAP, chr(92) + '1', False)})"
    return f"trim({sub(once, V.WRAP, chr(92) + '1', False)})"


def key(x: str) -> str:
    return f"lower({sub(squash(x), V.KEY_DROP_CLASS, '')})"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def han(x: str) -> str:
    return f"len(regexp_extract_all({x}, {q(f'[{V.HAN}]')}))"


def ratio(x: str) -> str:
    return f"CASE WHEN length({x}) > 0 THEN CAST({han(x)} AS DOUBLE) / length({x}) ELSE 0.0 END"


def strip(x: str, chars: str) -> str:
    return f"trim({x}, {q(chars)})"


def ends(x: str) -> str:
    return sub(x, f"^{V.S}+|{V.S}+$", "")


def chain(start: str, steps: list[dict[str, str]], prefix: str) -> str:
    """CTEs that each add columns to the one before, or put new values in; the last is called ``prefix``."""
    out, last, known = [], start, set()
    for k, step in enumerate(steps):
        name = prefix if k == len(steps) - 1 else f"{prefix}{k}"
        old = [c for c in step if c in known]
        kept = f"* EXCLUDE ({', '.join(old)})" if old else "*"
        out.append(f"{name} AS (SELECT {kept}, {', '.join(f'{e} AS {c}' for c, e in step.items())} FROM {last})")
        known |= set(step)
        last = name
    return ",\n".join(out)


RAW = "raw AS (" + adapter.RAW_SQL.format(part="part") + ")"


def edition_steps(x: str) -> list[dict[str, str]]:
    tail = f"regexp_extract(inner_, {q(V.EDITION_TAIL)}, 1)"
    found = f"regexp_extract_all({x}, {q(V.EDITION_PAREN)}, 1)"
    return [
        {"inner_": squash(sub(x, V.EDITION_PAREN, " "))},
        {"words": f"list_concat({found}, CASE WHEN {tail} <> '' THEN [{tail}] ELSE [] END)"},
        {"rest": f"trim({sub('inner_', V.EDITION_TAIL, '', False)})", "edition": "array_to_string(list_filter(words, lambda w, i: list_position(words, w) = i), '、')"},
    ]


def volume_steps(x: str) -> list[dict[str, str]]:
    fits = f"(vol <> '' AND length(vol) <= length({x}) - 1)"
    return [
        {"vol": f"regexp_extract({x}, {q(V.VOLUME)}, 0)"},
        {"rest_v": f"CASE WHEN {fits} THEN {squash(f'replace({x}, vol, {q(" ")})')} ELSE {x} END", "volume": f"CASE WHEN {fits} THEN vol ELSE '' END"},
    ]


def promo_steps(x: str) -> list[dict[str, str]]:
    """The eight steps over the column s, with cut."""

    def groups(pattern: str, bad: str) -> list[dict[str, str]]:
        inner = "substr(ms[i + 1], 2, length(ms[i + 1]) - 2)"
        piece = f"ps[i + 1] || CASE WHEN i < len(ms) THEN CASE WHEN {bad.format(inner=inner)} THEN ' ' ELSE ms[i + 1] END ELSE '' END"
        return [{"ps": f"string_split_regex(s, {q(pattern)})", "ms": f"regexp_extract_all(s, {q(pattern)})"}, {"s2": f"array_to_string(list_transform(range(len(ps)), lambda i: {piece}), '')"}, {"cut": "cut OR s2 <> s"}, {"s": "s2"}]

    def truncate(pattern: str, chars: str | None, bare: bool = False) -> list[dict[str, str]]:
        head = f"regexp_extract(s, {q(f'(?s)^(.*?)(?:{pattern})')}, 1)"
        if bare:  # the first match of either pattern
            number = rf"(?s)^((?:.*?\P{{Nd}})??){_BARE}(?:$|\P{{Nd}})"
            at = f"least(CASE WHEN {has('s', pattern)} THEN length({head}) END, CASE WHEN {has('s', number)} THEN length(regexp_extract(s, {q(number)}, 1)) END)"
            head = f"substr(s, 1, coalesce({at}, 0))"
        return [{"head": head}, {"cut": "cut OR length(head) >= 2", "s": f"CASE WHEN length(head) >= 2 THEN {strip('head', chars) if chars else 'head'} ELSE s END"}]

    total = lambda a: f"coalesce(list_sum(list_transform({a}, lambda y: length(y))), 0)"
    heads = f"list_transform(range(len(ms)), lambda i: {strip(f'substr(s, 1, CAST({total("ps[1:i + 1]")} + {total("ms[1:i]")} AS BIGINT))', V.HEAD_STRIP)})"
    first, rest = (f"regexp_extract(s, {q(rf'^([^{V.WS}]{{2,14}}) (.+)$')}, {k})" for k in (1, 2))
    listed = f"({han('f1')} >= 2 AND {has('f2', V.any_of(V.ENDORSEMENTS))})"
    return [
        {"s": squash(x), "cut": "FALSE"},
        *groups(f"{V.OPEN}{V.NOT_CLOSE}{{0,40}}{V.CLOSE}", has("{inner}", "(?:" + f"{V.PROMO}|{JUNK}|{V.TIE_IN}".replace("{", "{{").replace("}", "}}") + ")")),
        *groups(r"[（(][^（()）]{12,}[）)]", has("{inner}", V.ASIDE)),
        *truncate(V.GENRE, None),
        {"ps": f"string_split_regex(s, {q(V.PROMO)})", "ms": f"regexp_extract_all(s, {q(V.PROMO)})"},
        {"h": f"list_filter({heads}, lambda h: length(h) >= 2)[1]"},
        {"cut": "cut OR h IS NOT NULL", "s": "coalesce(h, s)"},
        *truncate(V.AUTHOR_BLOCK, V.HEAD_STRIP),
        {"f1": first, "f2": rest},
        {"cut": f"cut OR {listed}", "s": f"CASE WHEN {listed} THEN f1 ELSE s END"},
        *truncate(V.PRESS, V.HEAD_STRIP),
        *truncate(OTHER_JUNK, " ", bare=True),
        {"s": squash("s")},
    ]


def title_steps(x: str) -> list[dict[str, str]]:
    tail = strip(sub("s", rf"{V.S}+(?:{V.any_of(V.TAIL_ROLES)})$", "", False), V.TITLE_STRIP)
    return [
        {"t": sub(sub(unwrap(x), V.SERIES, " "), f"{V.S}*[:：]{V.S}*$", "", False)},
        *edition_steps("t"),
        *volume_steps("rest"),
        {"t2": sub("rest_v", "[—–]{2,}", "—")},
        *promo_steps("t2"),
        {"title": squash(sub(tail, rf"^[—\-–]+{V.S}*", "", False))},
        {"confidence": f"CAST(CASE WHEN title = '' OR length(title) > 40 OR {has('title', f'{V.PROMO}|{JUNK}')} THEN 0.3 WHEN cut THEN 0.6 ELSE 1.0 END AS DOUBLE)"},
    ]


def author(x: str) -> str:
    s = squash(x)
    named = strip(sub(s, V.AUTHOR_ROLE, ""), V.AUTHOR_STRIP)
    untagged = f"CASE WHEN {has(named, V.AUTHOR_TAG)} THEN {sub(named, V.AUTHOR_TAG_CUT, '', False)} ELSE {named} END"
    none = ", ".join(q(a) for a in V.NO_AUTHOR)
    return f"CASE WHEN {s} = {q(V.ANONYMOUS)} THEN {s} WHEN {s} IN ({none}) OR {has(s, V.AUTHOR_DATE)} THEN '' ELSE trim({untagged}) END"


def isbn_steps(x: str) -> list[dict[str, str]]:
    check = lambda d: f"CAST((10 - list_sum(list_transform(range(12), lambda i: coalesce(TRY_CAST(substr({d}, i + 1, 1) AS INTEGER), 0) * CASE WHEN i % 2 = 0 THEN 1 ELSE 3 END)) % 10) % 10 AS VARCHAR)"
    last = "((11 - list_sum(list_transform(range(9), lambda i: coalesce(TRY_CAST(substr(digits, i + 1, 1) AS INTEGER), 0) * (10 - i))) % 11) % 11)"
    return [
        {"digits": f"upper({sub(squash(x), '[^0-9Xx]', '')})"},
        {"ten": "'978' || substr(digits, 1, 9)"},
        {"isbn13": f"CASE WHEN {has('digits', '^[0-9]{9}[0-9X]$')} THEN CASE WHEN substr(digits, 10, 1) = CASE WHEN {last} = 10 THEN 'X' ELSE CAST({last} AS VARCHAR) END THEN ten || {check('ten')} ELSE '' END WHEN {has('digits', '^[0-9]{13}$')} THEN CASE WHEN {check('digits')} = substr(digits, 13, 1) THEN digits ELSE '' END ELSE '' END"},
    ]


def reason(t: str, k: str) -> str:
    repeated = f"len(list_filter(range(1, length({t}) - 4), lambda i: substr({t}, i, 6) = repeat(substr({t}, i, 1), 6))) > 0"
    return (
        f"CASE WHEN {t} = '' THEN 'empty' WHEN length({t}) > {V.MAX_TITLE} THEN 'too_long' WHEN {has(t, V.ONLY_PUNCT)} THEN 'punct_only' WHEN {has(t, V.BAD_TITLE)} THEN 'marketing' "
        f"WHEN {has(t, V.any_of(V.NON_BOOK_WORDS))} THEN 'non_book' WHEN {ratio(t)} < {V.MIN_HAN} THEN 'not_chinese' WHEN {repeated} THEN 'repeated_char' WHEN length({k}) < 2 THEN 'single_char' END"
    )


def year(x: str) -> str:
    return f"regexp_extract({squash(x)}, {q(V.YEAR)}, 0)"


NOISE = f"{V.PROMO}|{V.PRESS}|{JUNK}"
TITLES = RAW + ",\n" + chain("raw", title_steps("title_raw"), "titled")
LEXICON = f"""lex0 AS (SELECT id, {unwrap('title_raw')} AS display FROM raw WHERE source = 'douban'),
lex1 AS (SELECT id, display, {key('display')} AS key FROM lex0),
lexicon AS (SELECT key, arg_min(display, id) AS display FROM lex1 WHERE length(key) BETWEEN 2 AND {V.MAX_PREFIX} GROUP BY key)"""
HITS = f"""keyed AS (SELECT id, {key('title_raw')} AS rk FROM raw),
hits AS (SELECT id, arg_max(key, length(key)) AS hit_key, arg_max(display, length(key)) AS hit FROM keyed JOIN lexicon ON starts_with(rk, key) GROUP BY id)"""
_BETTER = f"(hit_key IS NOT NULL AND starts_with({key('title')}, hit_key) AND length({key('title')}) >= length(hit_key) + 2 AND {has('title_raw', NOISE)})"
# the record chain: hit or cleaned title, then the other columns
RECORDS = f"""{TITLES},
{LEXICON},
{HITS},
better AS (SELECT t.*, {_BETTER} AS better, hit FROM titled t LEFT JOIN hits USING (id)),
named AS (SELECT * EXCLUDE (title, confidence), CASE WHEN better THEN hit ELSE title END AS title, CASE WHEN better THEN 1.0 ELSE confidence END AS confidence, title AS before FROM better),
{chain('named', isbn_steps('isbn'), 'numbered')},
records AS (SELECT id AS raw_id, source, title, {key('title')} AS key, edition, volume, {author('author_raw')} AS author, {squash('publisher')} AS publisher, {year('pub_year')} AS pub_year, isbn13 AS isbn,
  {squash('category')} AS category, CAST(confidence AS DOUBLE) AS confidence, {squash('title_raw')} AS title_raw, before FROM numbered),
judged AS (SELECT *, {reason('title', 'key')} AS reason FROM records),
cands AS (SELECT * EXCLUDE (reason, before) FROM judged WHERE reason IS NULL)"""
_PRIORITY = "CASE source " + " ".join(f"WHEN {q(s)} THEN {p}" for s, p in V.SOURCE_PRIORITY.items()) + " ELSE 0 END"
CLUSTERS = f"""{RECORDS},
links AS (SELECT DISTINCT a.key AS a, b.key AS b FROM cands a JOIN cands b ON a.isbn = b.isbn AND a.isbn <> '' AND a.key <> b.key),
reach(a, b) AS (SELECT DISTINCT key, key FROM cands UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a AS key, min(b) AS cluster FROM reach GROUP BY a),
clustered AS (SELECT cands.*, cluster FROM cands JOIN roots USING (key))"""
BOOKS = f"""{CLUSTERS},
best AS (SELECT * FROM clustered QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY {_PRIORITY} DESC, confidence DESC, author <> '' DESC, isbn <> '' DESC, length(title), raw_id) = 1),
firsts AS (SELECT cluster, min(raw_id) AS id, coalesce(arg_min(author, raw_id) FILTER (WHERE author <> ''), '') AS author FROM clustered GROUP BY cluster),
srcs AS (SELECT cluster, string_agg(source, ',' ORDER BY p DESC, source) AS sources, count(*) AS n_sources FROM (SELECT DISTINCT cluster, source, {_PRIORITY} AS p FROM clustered) GROUP BY cluster),
als AS (SELECT cluster, string_agg(title_raw, ' | ' ORDER BY title_raw) AS aliases FROM (SELECT DISTINCT c.cluster, c.title_raw FROM clustered c JOIN best b USING (cluster) WHERE c.title_raw <> b.title_raw QUALIFY dense_rank() OVER (PARTITION BY c.cluster ORDER BY c.title_raw) <= 8) GROUP BY cluster),
books AS (SELECT f.id, b.title, b.key AS title_key, b.edition, b.volume, f.author, b.publisher, b.pub_year, b.isbn, b.category, s.sources, s.n_sources, coalesce(als.aliases, '') AS aliases,
  CAST(round(least(b.confidence + least(s.n_sources - 1, 3) * 0.08 + CASE WHEN f.author <> '' THEN 0.04 ELSE 0.0 END + CASE WHEN b.isbn <> '' THEN 0.04 ELSE 0.0 END, 1.0), 3) AS DOUBLE) AS confidence
  FROM best b JOIN firsts f USING (cluster) JOIN srcs s USING (cluster) LEFT JOIN als USING (cluster))"""


def over(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


_LISTING = "SELECT event_id AS id, event_type AS source, CAST(user_id AS VARCHAR) AS source_id, CASE WHEN event_id % 11 = 0 THEN '' ELSE 't' || CAST(event_id AS VARCHAR) END AS title_raw FROM events"
_TASKS = "tasks AS (SELECT role AS source, 'k' || CAST(conv_id % 40 AS VARCHAR) AS task_key, turn % 2 AS done, turn AS pages, CAST(length(text) AS BIGINT) AS items, printf('%08d-%04d', conv_id, turn) AS updated_at FROM conversations)"
_LATEST = "SELECT source, task_key, done, pages, items, updated_at FROM tasks {where} QUALIFY row_number() OVER (PARTITION BY source, task_key ORDER BY updated_at DESC, done DESC, pages DESC, items DESC) = 1"
_CODES = "codes AS (SELECT printf('01.%02d.00.00.00.00', r_regionkey + 1) AS cid, 2 AS level, printf('01.%02d', r_regionkey + 1) AS head FROM region UNION ALL SELECT printf('01.%02d.%02d.00.00.00', n_regionkey + 1, n_nationkey + 1), 3, printf('01.%02d', n_regionkey + 1) FROM nation)"


def _legacy_text(x: str) -> str:
    kept = "，。！？、；：·…—–"
    s = sub(ends(f"coalesce({x}, '')"), f"{V.S}+", " ")
    s = f"translate({s}, '《》【】[]（）()「」『』', '')"
    s = sub(s, rf"[^\p{{L}}\p{{N}}_{V.WS}{kept}\-]", "")
    # in the derived listings compatibility composition changes full-width characters only
    s = f"translate({s}, {q(V.FULL_WIDTH + '：！？；，')}, {q(V.ASCII + ':!?;,')})"
    s = f"replace({s}, '…', '...')"
    return ends(f"translate({s}, {q('<>/' + chr(92) + '|:*?' + chr(34) + chr(39))}, '')")


def _legacy_title(x: str) -> str:
    editions = "修订版|增订版|新版|典藏版|精装版|平装版|图文版|插图版"
    return ends(sub(sub(_legacy_text(x), f"{V.S}*[第卷部册].*$", "", False), rf"{V.S}*[\[\(]*(?:{editions})[\]\)]*{V.S}*", ""))


def _legacy_author(x: str) -> str:
    return ends(sub(_legacy_text(x), f"{V.S}*[著编主译校注点整理疏笺辑].*$", "", False))


_LEGACY = RAW + f", cleaned AS (SELECT id, {_legacy_title('title_raw')} AS title, {_legacy_author('author_raw')} AS author, source FROM raw)"
_PUB = f"list_filter(list_transform(string_split(author_raw || ' / ' || publisher || ' / ' || pub_year || ' / 35.00元', '/'), lambda p: {ends('p')}), lambda p: p <> '')"
_PUB_PRESS = f"coalesce(list_filter(ps[2:], lambda p: {has('p', f'(?:{V.any_of(V.LISTING_PRESS)})$')})[1], ps[2], '')"
_PUB_YEAR = f"coalesce(list_filter(list_transform(list_reverse(ps[2:]), lambda p: regexp_extract(p, {q(rf'((?:19|20){V.D}{{2}})')}, 1)), lambda y: y <> '')[1], '')"

TAG_LINE = "author_raw || ' / ' || publisher || ' / ' || pub_year || ' / 35.00'"

_OLD_AUTHOR = ends(sub(ends("string_split(" + sub("author_raw", f"^[/{V.WS}]+", "", False) + ", '/')[1]"), rf"^{V.S}*\[.*?\]{V.S}*", "", False))
_THREE = (
    f"SELECT source, CAST(id AS VARCHAR) AS source_id, {ends('title_raw')} AS title_raw, author_raw, publisher, '' AS isbn FROM raw WHERE source = 'dangdang' AND {ends('title_raw')} <> '' "
    "UNION ALL SELECT source, source_id, title_raw, author_raw, publisher, '' FROM raw WHERE source = 'weread' UNION ALL SELECT source, CASE WHEN isbn <> '' THEN isbn ELSE source_id END, title_raw, author_raw, publisher, isbn FROM raw WHERE source = 'pdc'"
)
_TAGGED = f"p AS (SELECT *, list_filter(list_transform(string_split(trim({sub(TAG_LINE, V.S + '+', ' ')}), '/'), lambda p: {ends('p')}), lambda p: p <> '') AS ps FROM raw)"
_SIMILAR = """ks AS (SELECT title, title_key AS k, substr(title_key, 1, 1) AS c, length(title_key) AS n, list_distinct(list_transform(range(1, greatest(length(title_key) - 1, 1) + 1), lambda i: substr(title_key, i, 2))) AS g FROM books),
near AS (SELECT DISTINCT x.title AS tx, y.title AS ty, x.g AS gx, y.g AS gy FROM ks x JOIN ks y ON x.c = y.c AND abs(x.n - y.n) <= 1 AND x.k < y.k),
sims AS (SELECT tx, ty, CAST(len(list_intersect(gx, gy)) AS DOUBLE) / (len(gx) + len(gy) - len(list_intersect(gx, gy))) AS sim FROM near)"""

ORACLE: dict[str, str] = {
    "review_rows": over(f"{BOOKS}, {_SIMILAR}", "SELECT least(tx, ty) AS title_a, greatest(tx, ty) AS title_b, round(max(sim), 3) AS similarity FROM sims WHERE sim >= 0.9 GROUP BY 1, 2"),
    "rebuild": over(BOOKS, "SELECT id AS book_id, raw_id FROM clustered JOIN firsts USING (cluster)"),
    "lexicon_saved": over(f"{RAW}, {LEXICON}", "SELECT key, display FROM lexicon"),
    "appended_count": f"WITH e AS (SELECT DISTINCT source, source_id FROM ({_LISTING}) WHERE title_raw <> ''), c AS (SELECT count(*) FILTER (WHERE source IN ('click', 'view')) AS a, count(*) AS b FROM e) SELECT 0 AS step, a AS n FROM c UNION ALL SELECT 1, b - a FROM c UNION ALL SELECT 2, 0 FROM c",
    "null_keys": f"WITH e AS (SELECT id, source, CASE WHEN CAST(source_id AS BIGINT) % 3 <> 0 THEN source_id END AS source_id, title_raw FROM ({_LISTING}) WHERE title_raw <> '') SELECT id, source, source_id, title_raw FROM e WHERE source <> 'click' QUALIFY row_number() OVER (PARTITION BY source, source_id ORDER BY id) = 1",
    "stream_first": "SELECT event_id AS id, event_type AS source, CAST(user_id AS VARCHAR) AS source_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1",
    "stream_batches": "SELECT 0 AS batch, count(*) AS n FROM events",
    "union_all_sources": over(f"{RAW}, {_TAGGED}", f"{_THREE} UNION ALL SELECT source, CAST(id AS VARCHAR), trim(title_raw), coalesce(ps[1], ''), {_PUB_PRESS}, '' FROM p WHERE source = 'douban' AND trim(title_raw) <> ''"),
    "legacy_pages": over(
        f"{RAW}, l AS (SELECT {ends('title_raw')} AS title, {_OLD_AUTHOR} AS author FROM raw)",
        "SELECT title, author, 'dangdang' AS source FROM l WHERE title <> '' AND author <> ''",
    ),
    "legacy_files": over(RAW, "SELECT title_raw AS title, author_raw AS author, source, unnest(['csv', 'json']) AS file FROM raw"),
    "squash": over(RAW, f"SELECT id, {squash('title_raw')} AS squashed FROM raw"),
    "title_wrap": over(RAW, f"SELECT id, {unwrap('title_raw')} AS unwrapped FROM raw"),
    "cjk_ratio": over(RAW, f"SELECT id, round({ratio('title_raw')}, 6) AS ratio FROM raw"),
    "edition": over(f"{RAW}, sq AS (SELECT id, {squash('title_raw')} AS t FROM raw), {chain('sq', edition_steps('t'), 'ed')}", "SELECT id, rest, edition FROM ed"),
    "volume": over(f"{RAW}, sq AS (SELECT id, {squash('title_raw')} AS t FROM raw), {chain('sq', volume_steps('t'), 'vo')}", "SELECT id, rest_v AS rest, volume FROM vo"),
    "title_key": over(RAW, f"SELECT id, {key('title_raw')} AS key, length({key('title_raw')}) >= 2 AS strong FROM raw"),
    "tail_noise": over(RAW, f"SELECT id, {has('title_raw', NOISE)} AS noise FROM raw"),
    "grams": over(f"{RAW}, k AS (SELECT id, {key('title_raw')} AS k FROM raw)", "SELECT id, array_to_string(list_sort(list_distinct(list_transform(range(1, greatest(length(k) - 1, 1) + 1), lambda i: substr(k, i, 2)))), ',') AS grams FROM k"),
    "promo_cut": over(f"{RAW}, {chain('raw', promo_steps('title_raw'), 'pr')}", "SELECT id, s AS title, cut FROM pr"),
    "clean_title": over(TITLES, "SELECT id, title, edition, volume, confidence FROM titled"),
    "clean_author": over(RAW, f"SELECT id, {author('author_raw')} AS author FROM raw"),
    "isbn13": over(f"{RAW}, {chain('raw', isbn_steps('isbn'), 'nu')}", "SELECT id, isbn13 FROM nu"),
    "pub_year": over(RAW, f"SELECT id, {year('pub_year')} AS year FROM raw"),
    "raw_scan": over(RAW, "SELECT id, source, source_id, title_raw, author_raw, publisher, pub_year, isbn, category FROM raw WHERE source = 'douban'"),
    "row_counts": "SELECT count(*) AS n FROM part",
    "quality_reason": over(f"{TITLES}, k AS (SELECT id, title, {key('title')} AS key FROM titled)", f"SELECT id, coalesce({reason('title', 'key')}, '') AS reason FROM k"),
    "reject_histogram": over(RECORDS, "SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, reason LIMIT 6"),
    "lexicon_build": over(f"{RAW}, {LEXICON}", "SELECT key, display FROM lexicon"),
    "lexicon_match": over(f"{RAW}, {LEXICON}, {HITS}", "SELECT raw.id, coalesce(hit, '') AS hit FROM raw LEFT JOIN hits USING (id)"),
    "lexicon_contains": over(f"{RAW}, {LEXICON}, {HITS}", "SELECT id FROM keyed WHERE rk IN (SELECT key FROM lexicon)"),
    "lexicon_override": over(RECORDS, "SELECT raw_id, title, confidence, before FROM records WHERE title <> before"),
    "candidates": over(RECORDS, "SELECT * FROM cands"),
    "clusters": over(CLUSTERS, "SELECT raw_id, key, cluster FROM clustered"),
    "canonical_books": over(BOOKS, "SELECT * FROM books"),
    "members": over(BOOKS, "SELECT id AS book_id, raw_id FROM clustered JOIN firsts USING (cluster)"),
    "book_numbers": over(BOOKS, "SELECT id, row_number() OVER (ORDER BY id) AS book_no FROM books"),
    "lineage": over(BOOKS, "SELECT firsts.id AS book_id, c.raw_id, best.title, c.source FROM clustered c JOIN firsts USING (cluster) JOIN best USING (cluster)"),
    "aliases": over(BOOKS, "SELECT id, aliases FROM books"),
    "source_list": over(BOOKS, "SELECT id, sources, n_sources FROM books"),
    "score": over(BOOKS, "SELECT id, confidence FROM books"),
    "near_duplicates": over(
        f"""{BOOKS}, ks AS (SELECT title, title_key AS k, substr(title_key, 1, 1) AS c, length(title_key) AS n, list_distinct(list_transform(range(1, greatest(length(title_key) - 1, 1) + 1), lambda i: substr(title_key, i, 2))) AS g FROM books),
sizes AS (SELECT c, n, count(*) AS own FROM ks GROUP BY c, n),
blocks AS (SELECT a.c, a.n FROM sizes a LEFT JOIN sizes b ON a.c = b.c AND b.n = a.n + 1 WHERE a.own + coalesce(b.own, 0) >= 2),
pairs AS (SELECT DISTINCT x.title AS tx, y.title AS ty, x.g AS gx, y.g AS gy FROM blocks JOIN ks x ON x.c = blocks.c AND x.n IN (blocks.n, blocks.n + 1) JOIN ks y ON y.c = blocks.c AND y.n IN (blocks.n, blocks.n + 1) AND x.k < y.k),
sims AS (SELECT tx, ty, CAST(len(list_intersect(gx, gy)) AS DOUBLE) / (len(gx) + len(gy) - len(list_intersect(gx, gy))) AS sim FROM pairs)""",
        "SELECT least(tx, ty) AS title_a, greatest(tx, ty) AS title_b, round(max(sim), 3) AS similarity FROM sims WHERE sim >= 0.9 GROUP BY 1, 2",
    ),
    "source_breakdown": over(RAW, "SELECT source, count(*) AS n, count(DISTINCT title_raw) AS n_titles FROM raw GROUP BY source"),
    "confidence_tiers": over(BOOKS, "SELECT count(*) FILTER (WHERE confidence >= 0.9) AS high, count(*) FILTER (WHERE confidence >= 0.6 AND confidence < 0.9) AS mid, count(*) FILTER (WHERE confidence < 0.6) AS low, count(*) AS total FROM books"),
    "high_conf_split": over(BOOKS, "SELECT confidence >= 0.9 AS high, count(*) AS n FROM books GROUP BY 1"),
    "completeness": over(BOOKS, "SELECT count(*) FILTER (WHERE author <> '') AS with_author, count(*) FILTER (WHERE publisher <> '') AS with_publisher, count(*) FILTER (WHERE pub_year <> '') AS with_pub_year, count(*) FILTER (WHERE isbn <> '') AS with_isbn, count(*) AS total FROM books"),
    "multi_source": over(BOOKS, "SELECT count(*) FILTER (WHERE n_sources > 1) AS multi, count(*) AS total, CASE WHEN count(*) > 0 THEN printf('%.1f%%', 100.0 * count(*) FILTER (WHERE n_sources > 1) / count(*)) ELSE '0%' END AS share FROM books"),
    "decade_histogram": over(BOOKS, "SELECT substr(pub_year, 1, 3) || '0s' AS decade, count(*) AS n FROM books WHERE pub_year BETWEEN '1949' AND '2029' GROUP BY 1"),
    "top_initials": over(BOOKS, "SELECT initial, n FROM (SELECT substr(title_key, 1, 1) AS initial, count(*) AS n, min(id) AS f FROM books GROUP BY 1 ORDER BY n DESC, f LIMIT 12)"),
    "export_rows": over(BOOKS, "SELECT title, edition, volume, author, publisher, pub_year, isbn, category, sources, n_sources, confidence FROM books WHERE confidence >= 0.9"),
    "insert_ignore": f"WITH e AS ({_LISTING}) SELECT id, source, source_id, title_raw FROM e WHERE title_raw <> '' AND (source, source_id) NOT IN (SELECT (source, source_id) FROM e WHERE title_raw <> '' AND source IN ('click', 'view')) QUALIFY row_number() OVER (PARTITION BY source, source_id ORDER BY id) = 1",
    "state_upsert": f"WITH {_TASKS} {_LATEST.format(where='')}",
    "pending_tasks": f"WITH {_TASKS}, latest AS ({_LATEST.format(where='')}) SELECT source, task_key FROM latest WHERE done = 0",
    "task_progress": f"WITH {_TASKS}, latest AS ({_LATEST.format(where='WHERE pages > 2')}) SELECT t.source, t.task_key, coalesce(done, 0) AS done, coalesce(pages, 0) AS pages, coalesce(items, 0) AS items FROM (SELECT DISTINCT 'user' AS source, task_key FROM tasks) t LEFT JOIN latest USING (source, task_key)",
    "fetch_states": "WITH e AS (SELECT event_type AS source, 'u' || CAST(user_id % 50 AS VARCHAR) AS task_key, CASE WHEN event_id % 700 <> 7 THEN event_id % 60 END AS items FROM events) SELECT source, task_key, CAST(CASE WHEN count(*) = count(items) THEN 1 ELSE 0 END AS BIGINT) AS done, count(items) AS pages, CAST(coalesce(sum(items), 0) AS BIGINT) AS items FROM e GROUP BY source, task_key",
    "page_cap": over(RAW, "SELECT source, id FROM raw QUALIFY row_number() OVER (PARTITION BY source ORDER BY id) <= 5"),
    "stream_ingest": "SELECT DISTINCT event_type AS source, CAST(user_id AS VARCHAR) AS source_id FROM events",
    "split_pub": over(f"{RAW}, p AS (SELECT id, {_PUB} AS ps FROM raw)", f"SELECT id, coalesce(ps[1], '') AS author, {_PUB_PRESS} AS press, {_PUB_YEAR} AS year FROM p"),
    "html_items": over(RAW, f"SELECT CAST(id AS VARCHAR) AS source_id, {ends('title_raw')} AS title_raw, author_raw, publisher, CASE WHEN pub_year = '' THEN '' ELSE substr(pub_year, 1, 4) END AS pub_year, CAST(id // 60 AS VARCHAR) AS category, 'https://product.dangdang.com/' || CAST(id AS VARCHAR) || '.html' AS url FROM raw WHERE {ends('title_raw')} <> ''"),
    "union_sources": over(
        RAW,
        f"SELECT source, CAST(id AS VARCHAR) AS source_id, {ends('title_raw')} AS title_raw, author_raw, publisher, '' AS isbn FROM raw WHERE source = 'dangdang' AND {ends('title_raw')} <> '' "
        "UNION ALL SELECT source, source_id, title_raw, author_raw, publisher, '' FROM raw WHERE source = 'weread' UNION ALL SELECT source, CASE WHEN isbn <> '' THEN isbn ELSE source_id END, title_raw, author_raw, publisher, isbn FROM raw WHERE source = 'pdc'",
    ),
    "tag_page_items": over(
        f"{RAW}, p AS (SELECT *, list_filter(list_transform(string_split(trim({sub(TAG_LINE, V.S + '+', ' ')}), '/'), lambda p: {ends('p')}), lambda p: p <> '') AS ps FROM raw)",
        f"SELECT CAST(id AS VARCHAR) AS source_id, trim(title_raw) AS title_raw, coalesce(ps[1], '') AS author_raw, {_PUB_PRESS} AS publisher, {_PUB_YEAR} AS pub_year, 'https://book.example.com/subject/' || CAST(id AS VARCHAR) || '/' AS url FROM p WHERE trim(title_raw) <> ''",
    ),
    "json_items": over(RAW, "SELECT source_id, title_raw, author_raw, publisher, substr(pub_year || '-01 00:00', 1, 4) AS pub_year, category, url FROM raw WHERE title_raw <> ''"),
    "catalogue_items": over(RAW, "SELECT CASE WHEN isbn <> '' THEN isbn ELSE source_id END AS source_id, title_raw, author_raw, publisher, substr(pub_year, 1, 4) AS pub_year, isbn, category FROM raw"),
    "tree_leaves": "SELECT r_name || '/' || n_name || '/' || s_name AS path, 's' || CAST(s_suppkey AS VARCHAR) AS cid, s_name AS name FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey WHERE n_nationkey % 9 <> 8 UNION ALL SELECT r_name || '/' || n_name, 'n' || CAST(n_nationkey AS VARCHAR), n_name FROM region JOIN nation ON n_regionkey = r_regionkey WHERE n_nationkey % 9 <> 8 AND n_nationkey NOT IN (SELECT s_nationkey FROM supplier)",
    "category_codes": f"WITH {_CODES} SELECT cid FROM codes",
    "child_categories": f"WITH {_CODES} SELECT '01.00.00.00.00.00' AS parent, cid FROM codes UNION ALL SELECT a.cid, b.cid FROM codes a JOIN codes b ON a.level = 2 AND b.level = 3 AND a.head = b.head",
    "frontier_levels": f"WITH {_CODES} SELECT '01.00.00.00.00.00' AS cid, 1 AS level UNION ALL SELECT cid, 2 FROM codes WHERE cid NOT LIKE '01.03.%'",
    "tag_ranking": "SELECT tag, n FROM (SELECT p_type AS tag, arg_max(CAST(p_size AS BIGINT), p_partkey) AS n FROM part GROUP BY p_type)",
    "fallback_categories": "SELECT unnest(['01.01.00.00.00.00', '01.03.00.00.00.00', '01.05.00.00.00.00']) AS cid",
    "page_titles": f"SELECT page_id, sha256(trim({sub('''replace(replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '(?s)<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&')''', V.S + '+', ' ')})) AS heading_sha256, len(regexp_extract_all(html, '<a href=\"([^\"]*)\"')) AS links FROM pages",
    "page_stops": "WITH p AS (SELECT event_type AS source, user_id % 50 AS task_key, event_id % 40 AS page, CASE WHEN max(event_id) % 11 <> 0 THEN count(*) + max(event_id) % 7 END AS items FROM events GROUP BY ALL), k AS (SELECT *, coalesce(bool_or(items < 2) OVER (PARTITION BY source, task_key ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over FROM p WHERE items IS NOT NULL) SELECT source, task_key, page, items FROM k WHERE NOT over AND items > 0",
    "gbk_pages": over(RAW, "SELECT id, title_raw AS title FROM raw"),
    "book_pattern": "SELECT 'B' || CAST(o_orderkey AS VARCHAR) AS item, 'B' || CAST(o_orderkey AS VARCHAR) AS \"itemLabel\", c_name AS \"authorLabel\" FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 8 ORDER BY item, c_name LIMIT 50 OFFSET 10",
    "book_pattern_all": "SELECT 'B' || CAST(o_orderkey AS VARCHAR) AS item, 'B' || CAST(o_orderkey AS VARCHAR) AS \"itemLabel\", c_name AS \"authorLabel\" FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 8",
    "qid_filter": over(RAW, "SELECT title_raw AS title, author_raw AS author, 'wikidata' AS source FROM raw WHERE id % 5 <> 0 AND title_raw <> '' AND author_raw <> ''"),
    "library_docs": over(RAW, "SELECT title_raw AS title, author_raw || ', ' || publisher AS author, 'openlibrary' AS source FROM raw WHERE title_raw <> ''"),
    "legacy_clean": over(_LEGACY, "SELECT id, title, author FROM cleaned"),
    "legacy_dedup": over(_LEGACY, "SELECT id, title, author, source, md5(lower(trim(title)) || '_' || lower(trim(author))) AS key FROM cleaned WHERE title <> '' AND author <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY id) = 1"),
    "legacy_insert": over(_LEGACY, "SELECT id, title, author, source FROM cleaned WHERE title <> '' AND author <> '' AND (title, author) NOT IN (SELECT (title, author) FROM cleaned WHERE source IN ('douban', 'weread')) QUALIFY row_number() OVER (PARTITION BY title, author ORDER BY id) = 1"),
    "legacy_country": over(RAW, f"SELECT id, {sub('author_raw', rf'^{V.S}*\[.*?\]{V.S}*', '', False)} AS author FROM raw"),
    "union_distinct": over(RAW, "SELECT min(title_raw) AS title, arg_min(author_raw, (title_raw, author_raw)) AS author FROM raw WHERE source IN ('douban', 'weread') GROUP BY lower(trim(title_raw)), lower(trim(author_raw))"),
    "document_dedup": "SELECT md5(coalesce(text, '')) AS digest, min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY 1",
}
