"""SQL of ``op13_conversation_repair``: a forward search over (cost, edits) in place of the operator's backward vectors."""

from __future__ import annotations


def _from(state: int, cost: str, letter: str, line: str) -> str:
    return (
        f"case when s[{state}] is not null then {{'cost': s[{state}].cost + {cost}, 'audit': s[{state}].audit || '{letter}', "
        f"'body': s[{state}].body || {line}}} end"
    )


def _least(*paths: str) -> str:
    return "list_min([" + ", ".join(paths) + "])"


_NONE, _KEPT = "[]::varchar[]", "[x.role || ':' || x.text]"
_STATES = (1, 2, 3, 4)  # nothing yet, system, user, assistant
_STAY = "(case when x.cut then 5 else 0 end)"


def _turn(state: int, name: str, initial: str, before: tuple[int, ...]) -> str:
    """Least path into a state by one turn: deleted, kept, or given the state's role."""
    deleted = _from(state, "2", "D", _NONE)
    kept = [f"case when not x.go and x.initial = '{initial}' then {_from(b, _STAY, 'K', _KEPT)} end" for b in before]
    new = [
        f"case when not x.go then {_from(b, f'{_STAY} + 1', 'R', f'[{chr(39)}{name}:{chr(39)} || x.text]')} end"
        for b in before if name != "system"
    ]
    return _least(deleted, *kept, *new)


_INSERTS = ", ".join([
    "s[1]", "s[2]",
    _least("s[3]", *(_from(b, "5", "I", "['user:']") for b in (1, 2, 4))),
    _least("s[4]", _from(3, "5", "I", "['assistant:']")),
])
_TURNS = ", ".join([
    _least(_from(1, "2", "D", _NONE)), _turn(2, "system", "s", (1,)),
    _turn(3, "user", "u", (1, 2, 4)), _turn(4, "assistant", "a", (3,)),
])
_CRC = """xor(4294967295, list_reduce(list_transform(range(strlen(k)), lambda i: ord(k[i + 1])::bigint),
    lambda c, b: list_reduce(range(8), lambda v, j: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295::bigint))"""

ORACLE = rf"""
    with keyed as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
        from conversations
    ), faulty as (
        select *, {_CRC} % 20 as fault from keyed
    ), damaged as (
        select conv_id, turn, case when fault = 4 then 'user' else role end as role,
            case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
        from faulty, lateral (select unnest(range(case when fault = 3 then 2 else 1 end))) where fault <> 0
    ), placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged
    ), seen as (
        select *, row_number() over (partition by conv_id, role, text order by i) as copy,
            not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
            regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last_shown,
            lag(role[1]) over (partition by conv_id order by i) || role[1] as pair from placed
    ), judged as (
        select *, not blank and copy > 1 as repeated,
            not blank and copy = 1 and last_shown not in ('.', '!', '?') as cut from seen
    ), one as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
            count(*) filter (blank) as blank, count(*) filter (repeated) as duplicate, count(*) filter (cut) as truncated,
            count(*) filter (pair not in ('su', 'ua', 'au')) as illegal,
            list({{'ins': false, 'initial': role[1], 'go': blank or repeated, 'cut': cut, 'role': role, 'text': text}} order by i) as turns
        from judged group by conv_id
    ), steps as (
        select *, {{'ins': true, 'initial': '', 'go': false, 'cut': false, 'role': '', 'text': ''}} as gap from one
    ), solved as (
        select *, list_reduce(
            flatten(list_transform(turns, lambda t: [gap, gap, t])) || [gap, gap],
            lambda s, x: case when x.ins then [{_INSERTS}] else [{_TURNS}] end,
            [{{'cost': 0::bigint, 'audit': '', 'body': {_NONE}}}, null, null, null]
        ) as ends from steps
    ), best as (
        select *, list_min([ends[1], ends[4]]) as found from solved
    )
    select conv_key as conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
        coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(found.cost, 0)::bigint as cost,
        coalesce(found.audit, '') as audit, sha256(coalesce(array_to_string(found.body, chr(10)), '')) as repaired_sha256
    from (select distinct conv_id as conv_key from conversations) left join best on conv_id is not distinct from conv_key
"""
