"""DuckDB statements for the queries of this subpackage that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
with d as (select doc_id, {LOWER} as t from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from d window w as (partition by t)
"""

QUALITY_RULES = rf"""
with w as (select doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents),
windows as (select doc_id, i, array_to_string(words[i:i + 7], ' ') as t from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from w where len(words) > 8)),
again as (select doc_id, i from (select *, count(*) over (partition by doc_id, t) as n from windows) where n > 1),
covered as (select doc_id, sum(least(8, coalesce(lead_i - i, 8)))::bigint as n from (select doc_id, i, lead(i) over (partition by doc_id order by i) as lead_i from again) group by 1),
lines as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as ls from w),
m as (
  select w.doc_id, w.source, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words
  from w join lines using (doc_id) left join covered using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m),
hosts as (select source, count(*) as n, count(*) filter (base_failed) as bad from b group by 1),
sums as (select count(*) as h, sum(n)::double as rows, sum(n::double * n) / sum(n) / sum(n) as q, sum(bad) / sum(n) as m, sum(bad::double * bad / n) / sum(n) as p2 from hosts),
corr as (select m, ((p2 - m * m) / nullif(m * (1 - m), 0) - (h - 1) / rows) / nullif(1 - q - (h - 1) / rows, 0) as r from sums),
prior as (select m, case when r > 0 then least(1000, greatest(1, 1 / r - 1)) else 1000 end as k from corr),
verdicts as (select source, (bad + m * k) / (n + k) as shrunk_rate from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and shrunk_rate <= 0.5 as kept
from b join verdicts on b.source is not distinct from verdicts.source
"""

MIXING = rf"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank from d group by source),
w as (select *, [3.0, 1.0, 2.0][rank % 3 + 1]::double as weight, 2.0::double * source_size as cap from s),
l as (
  select *, 1.5::double * sum(source_size) over () as budget,
    (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as level
  from w),
t as (
  select *, case when cap / weight > level then weight * (select arg_min(level, cap / weight) from l where cap / weight > level) else cap end as target
  from l),
p as (
  select d.*, pass, t.source_size, t.target, t.rank, t.budget, md5('mix:' || pass || ':' || coalesce(doc_id::varchar, 'null')) as key
  from d join t on d.source is not distinct from t.source, (values (1), (2)) v(pass)),
f as (select *, (sum(size) over (partition by rank order by pass, key, size rows unbounded preceding))::bigint / nullif(target, 0) as finish from p),
g as (select *, sum(size) over (order by finish, rank, pass, key, size rows unbounded preceding) as done from f)
select doc_id, any_value(size) as size, any_value(source_size) as source_size, any_value(target) as target,
  coalesce(sum(size) filter (done <= budget), 0)::bigint as taken
from g group by doc_id
"""



def _more(audit: str, cost: str | int, edit: str) -> str:
    """An audit, twelve digits of cost and its edits, with one more edit; nulls stay null."""
    return f"(lpad(({audit}[1:12]::bigint + {cost})::varchar, 12, '0') || {audit}[13:] || '{edit}')"


def _step() -> str:
    """Audits by state (nothing, system, user, assistant) after one more row, which is its initial and b (to be deleted), t (truncated) or neither."""
    stays, mend = "row[2] <> 'b'", "(case row[2] when 't' then 3 else 0 end)"
    n, s, u, a = (f"acc[{k}]" for k in range(1, 5))
    dropped = [_more(x, 4, "D") for x in (n, s, u, a)]

    def to(sources: list[str], initial: str, rerole: bool = True) -> str:
        kept = ", ".join(f"case when {stays} and row[1] = '{initial}' then {_more(x, mend, 'K')} end" for x in sources)
        return kept + "".join(f", case when {stays} then {_more(x, f'{mend} + 3', 'R')} end" for x in sources if rerole)

    return f"[{dropped[0]}, least({dropped[1]}, {to([n], 's', False)}), least({dropped[2]}, {to([n, s, a], 'u')}), least({dropped[3]}, {to([u], 'a')})]"


def _inserted(rows: str) -> str:
    users = f"list_transform([{rows}], lambda b: [b[1], b[2], least(b[3], {', '.join(_more(f'b[{k}]', 3, 'I') for k in (1, 2, 4))}), b[4]])"
    return f"list_transform({users}, lambda b: [b[1], b[2], b[3], least(b[4], {_more('b[3]', 3, 'I')})])[1]"


CRC32 = "xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)))"

TURN_REPAIR = f"""
with k as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {CRC32.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
  from conversations),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(case when kind = 3 then [0, 1] else [0] end) from k where kind <> 0)),
seen as (
  select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as said,
    row_number() over (partition by conv_id, role, text order by turn nulls first) > 1 as again
  from damaged),
faults as (select *, case when said = '' then 'blank' when again then 'duplicate' when right(said, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from seen),
placed as (select *, left(lag(role) over w, 1) || left(role, 1) as pair, row_number() over w as place from faults window w as (partition by conv_id order by turn nulls first, role, text, again)),
found as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal,
    list([left(role, 1), case fault when '' then '' when 'truncated' then 't' else 'b' end] order by place) as marks, list([role, text] order by place) as lines
  from placed group by conv_id),
audits as (select *, list_reduce(list_concat([{_inserted("['000000000000', null, null, null]")}], marks), lambda acc, row: {_inserted(_step())}) as best from found),
chosen as (select *, least(best[1], best[4]) as audit_of from audits),
repaired as (
  select *, list_reduce(list_concat([['0', '1', '']], list_transform(string_split(audit_of[13:], ''), lambda e: [e])), lambda acc, e:
    case e[1] when '' then acc when 'D' then [acc[1], (acc[2]::bigint + 1)::varchar, acc[3]]
      when 'K' then [case left(lines[acc[2]::bigint][1], 1) when 's' then '1' when 'u' then '2' else '3' end, (acc[2]::bigint + 1)::varchar, acc[3] || chr(10) || lines[acc[2]::bigint][1] || ':' || lines[acc[2]::bigint][2]]
      when 'R' then [case acc[1] when '2' then '3' else '2' end, (acc[2]::bigint + 1)::varchar, acc[3] || chr(10) || case acc[1] when '2' then 'assistant:' else 'user:' end || lines[acc[2]::bigint][2]]
      else [case acc[1] when '2' then '3' else '2' end, acc[2], acc[3] || chr(10) || case acc[1] when '2' then 'assistant:' else 'user:' end] end)[3] as said
  from chosen)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(audit_of[1:12]::bigint, 0) as cost, coalesce(audit_of[13:], '') as audit, sha256(coalesce(said[2:], '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join repaired r on c.conv_id is not distinct from r.conv_id
"""
