"""SQL fragments the checks share."""

from __future__ import annotations

from collections.abc import Sequence

from caseloom.functions.rules import (
    ANTIGEN_RULES,
    BRAND_BY_DESCRIPTION,
    BRAND_BY_NAME,
    FLU_INACTIVATED,
    FLU_LIVE,
    FLU_WORDS,
    MRNA_NAME,
)
from caseloom.functions.scalars import NUMBER_PATTERN, RANGE_NUMBER_PATTERN


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def number(c: str) -> str:
    return (
        f"(case when regexp_matches({c}, {text(NUMBER_PATTERN)}) "
        f"then try_cast(trim({c}) as double) end)"
    )


def any_of(c: str, words: Sequence[str]) -> str:
    return "(" + " or ".join(f"contains({c}, {text(w)})" for w in words) + ")"


def one_of(c: str, values: Sequence[str]) -> str:
    return f"{c} in ({', '.join(text(v) for v in values)})"


def first_match(c: str, rules: Sequence[tuple[Sequence[str], str]], default: str) -> str:
    arms = " ".join(f"when {any_of(c, words)} then {text(name)}" for words, name in rules)
    return f"case {arms} else {default} end"


def range_flag(source: str, keep: str = "*") -> str:
    """Rows of ``source`` with ``value_normal``."""
    return f"""
select {keep}, cast(case
  when normal_range is null or normal_range = '-' or test_result = 'unknown' then null
  when normal_range = test_result then 0
  when len(nums) = 2 then case
    when v is null or lo is null then null
    when v < lo then 1
    when hi is null then null
    when v <= hi then 0 else 1 end
  when len(nums) = 1 then case
    when sign not in ('>=', '<=', '<', '>') then 1
    when v is null or lo is null then null
    when sign = '>=' and v >= lo then 0
    when sign = '<=' and v <= lo then 0
    when sign = '<' and v < lo then 0
    when sign = '>' and v > lo then 0
    else 1 end
  else 1 end as int) as value_normal
from (
  select *, try_cast(nums[1] as double) as lo, try_cast(nums[2] as double) as hi from (
    select *, {number('test_result')} as v,
      regexp_extract_all(translate(normal_range, '-', ','), {text(RANGE_NUMBER_PATTERN)}, 0) as nums,
      regexp_replace(translate(normal_range, '-', ','), '[^<=>]', '', 'g') as sign
    from {source}))"""


def brand(name: str, description: str) -> str:
    by_name = " ".join(f"when {name} = {text(n)} then {text(b)}" for n, b in BRAND_BY_NAME)
    by_description = first_match(description, BRAND_BY_DESCRIPTION, "'Unspecified'")
    return (
        f"case when contains({name}, 'COVID-19') then case when {name} = {text(MRNA_NAME)} "
        f"then {by_description} {by_name} else 'Unspecified' end end"
    )


def flu(name: str, strict: bool = False) -> str:
    about = any_of(f"lower({name})", FLU_WORDS)
    if strict:
        about += f" and not contains(lower({name}), 'haemophilus')"
    return (
        f"case when {about} then case when {one_of(name, FLU_LIVE)} then 'Live' "
        f"when {one_of(name, FLU_INACTIVATED)} then 'Inactivated' else 'Unspecified' end end"
    )


def antigen_flags(name: str) -> dict[str, str]:
    return {f: f"cast({any_of(f'lower({name})', words)} as int)" for f, words in ANTIGEN_RULES}


def fraction(key: str, seed: int) -> str:
    """Random but fixed number in [0, 1) of an entity."""
    return (
        f"(cast(concat('0x', substr(md5(concat(cast({key} as string), '|{seed}')), 1, 8)) "
        f"as bigint) / 4294967296.0)"
    )


def digest(key: str, seed: int) -> str:
    return f"md5(concat(cast({key} as string), '|{seed}'))"
