"""SQL for the queries that SQL can express."""

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _digest_part(at: int) -> str:
    digits = f"to_base(cast('0x' || substr(sha1(payload), {at}, 10) as bigint), 32, 8)"
    return f"translate({digits}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"


WARC = f"""
with p as (select page_id, coalesce(html, '') payload from pages),
d as (
    select page_id, octet_length(encode(payload)) payload_bytes,
        {" || ".join(_digest_part(at) for at in (1, 11, 21, 31))} payload_digest,
        min(page_id) over (partition by payload) original
    from p
)
select page_id, payload_bytes, payload_digest,
    case when page_id = original then 'response' else 'revisit' end record_type,
    case when page_id <> original then original end refers_to
from d
"""


def _rest(url: str) -> str:
    return f"case when instr({url}, '://') > 0 then substr({url}, instr({url}, '://') + 3) else '' end"


def _host(url: str) -> str:
    return f"translate(regexp_extract({_rest(url)}, '(?s)^[^/?#]*'), {LETTERS})"


def _path(url: str) -> str:
    return f"regexp_extract({_rest(url)}, '(?s)^[^/?#]*([^?#]*)', 1)"


def _form(url: str) -> str:
    query = f"regexp_extract(regexp_replace({_rest(url)}, '(?s)#.*$', ''), '(?s)\\?(.*)$', 1)"
    asked = (
        f"list_sort(list_filter(string_split({query}, '&'), "
        "lambda x: x <> '' and not regexp_matches(x, '^(?:utm_[a-z]+|ref|gclid|fbclid)(?:=|$)')))"
    )
    return (
        f"case when instr({url}, '://') > 0 then "
        f"regexp_replace({_host(url)}, '^(?:www|m)\\.|:(?:80|443)$', '', 'g') "
        f"|| regexp_replace({_path(url)}, '/+$', '') "
        f"|| case when len({asked}) > 0 then '?' || array_to_string({asked}, '&') else '' end end"
    )


def _rule_case(value: str, rules: list[tuple[str, str]]) -> str:
    tests = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0])):
        host, _, path = rule.partition("/")
        found = rule if value == "rule" else verdict
        tests.append(f"when (host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}') then '{found}'")
    return f"case {' '.join(tests)} end"


def url_filters(rules: list[tuple[str, str]]) -> str:
    """``rules``: (verdict, rule). Aliases are equal forms and what absolute canonical links join."""
    return f"""
with recursive judged as (
    select page_id, {_host("u")} host, {_path("u")} path, {_form("u")} form, target
    from (
        select page_id, coalesce(url, '') u,
            nullif(regexp_extract(coalesce(html, ''),
                '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1), '') target
        from pages
    )
),
ruled as (
    select *, {_rule_case("rule", rules)} as rule, {_rule_case("verdict", rules)} ruling from judged
),
edges as (
    select form a, {_form("target")} b from judged where instr(target, '://') > 0
),
reach as (
    select distinct form a, form b from judged where form is not null
    union
    select r.a, case when e.a = r.b then e.b else e.a end from reach r join edges e on r.b in (e.a, e.b)
),
named as (
    select {_form("target")} form, {_host("target")} host, {_path("target")} path from judged where instr(target, '://') > 0
),
blocked as (
    select distinct reach.a from reach join ruled on ruled.form = reach.b where ruling = 'block'
    union
    select distinct reach.a from reach join named on named.form = reach.b where {_rule_case("verdict", rules)} = 'block'
)
select page_id, host, path, rule,
    coalesce(ruling, case when form in (select a from blocked) then 'block' end, 'allow') verdict
from ruled
"""


EXACT_DEDUP = """
select doc_id,
       max(doc_id) over equals as keep_id,
       count(*) over equals as group_size,
       doc_id = max(doc_id) over equals as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
window equals as (partition by coalesce(text, ''))
"""

COLLOCATIONS = f"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), {LETTERS}), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents
),
words as (
    select lang, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda x: x <> '') as w from pieces
),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
places as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
grams as (
    select lang, w[i : i + k - 1] as g from places, (values (1), (2), (3), (4)) sizes(k) where i + k - 1 <= len(w)
),
counts as (select lang, g, count(*) as f from grams group by lang, g having count(*) >= 30),
cuts as (
    select c.lang, c.g, c.f as a, k, l.f as l, r.f as r, cast(2000000 as hugeint) * c.f // (l.f + r.f) as score
    from (select *, unnest(range(1, len(g))) as k from counts where len(g) > 1) c
    join counts l on l.lang = c.lang and l.g = c.g[1 : k]
    join counts r on r.lang = c.lang and r.g = c.g[k + 1 : len(c.g)]
),
best as (select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
inner_phrases as (
    select lang, g[i : i + k - 1] as g, max(f) as longest
    from (select *, unnest(range(1, len(g) + 1)) as i from counts), (values (2), (3)) sizes(k)
    where k < len(g) and i + k - 1 <= len(g)
    group by all
),
kept as (
    select b.* from best b left join inner_phrases p on p.lang = b.lang and p.g = b.g
    where p.longest is null or 100 * cast(p.longest as hugeint) < 80 * cast(b.a as hugeint)
),
ranked as (
    select lang, array_to_string(g, ' ') as phrase, a, l, r, cast(score as bigint) as score,
        row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank
    from kept
)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join totals on totals.lang = ranked.lang where rank <= 2000
"""
