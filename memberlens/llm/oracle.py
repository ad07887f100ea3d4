"""DuckDB SQL for the operators that SQL can express."""

from memberlens.llm.license_rules import RULES, SENTENCES

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

_MIX = f"""
with d as (select doc_id, source, {_WORDS}::bigint as size,
                  ('0x' || substr(md5(coalesce(doc_id::varchar, '') || chr(10) || coalesce(text, '')), 1, 15))::bigint as hash from documents),
s as (select source, sum(size)::bigint as source_size,
             [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
      from d group by source),
c as (select *, 3.0::double * source_size as cap, sum(source_size) over ()::double as total from s),
l as (select *, (total - coalesce(sum(cap) over (order by cap / weight, source nulls last
                                                 rows between unbounded preceding and 1 preceding), 0.0))
             / sum(weight) over (order by cap / weight, source nulls last
                                 rows between current row and unbounded following) as level from c),
f as (select *, max(case when level * weight <= cap then level end) over () as fill from l),
t as (select source, source_size, least(cap, coalesce(fill * weight, cap)) as target from f),
k as (select *, floor(target / greatest(source_size, 1))::bigint as copies from t),
g as (select source, hash, sum(size) as words from d group by source, hash),
h as (select source, hash, words, coalesce(sum(words) over (partition by source order by hash
             rows between unbounded preceding and 1 preceding), 0) as before from g)
select d.doc_id, d.size, k.source_size, k.target,
       (d.size * (k.copies + case when k.copies < 3 and h.before * 2 + h.words < (k.target - k.copies * k.source_size) * 2
                             then 1 else 0 end))::bigint as taken
from d join k on d.source is not distinct from k.source
join h on h.source is not distinct from d.source and h.hash = d.hash
"""


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _normal(expr: str) -> str:
    return f"trim(regexp_replace(lower({expr}), '[^a-z0-9]+', ' ', 'g'))"


_KNOWN = ", ".join(f"({_normal(_quoted(s))}, {_quoted(sid)})" for sid, s in sorted(SENTENCES.items()))
_HELD = ", ".join(
    "case when " + " or ".join(f"regexp_matches(trail, {_quoted(' ' + ' (.* )?'.join(o) + ' ')})" for o in orders)
    + f" then {_quoted(name)} end" for name, orders in sorted(RULES.items()))

_LICENSES = f"""
with known(sentence, sid) as (values {_KNOWN}),
doc as (select row_number() over () as rid, doc_id, text from documents),
cut as (select rid, string_split(regexp_replace(coalesce(text, ''), '([.!?;]) +', '\\1' || chr(10), 'g'), chr(10)) as parts
        from doc),
part as (select rid, unnest(parts) as sentence, generate_subscripts(parts, 1) as pos from cut),
hit as (select rid, pos, sid from part join known on {_normal('part.sentence')} = known.sentence),
ids as (select rid, list(sid order by pos) as found from hit group by rid),
each_ as (select doc_id, coalesce(found, []) as found from doc left join ids using (rid)),
trails as (select doc_id, found, ' ' || array_to_string(found, ' ') || ' ' as trail from each_)
select doc_id, len(found)::bigint as n_sentences, array_to_string(found, ',') as sentence_ids,
       array_to_string([x for x in [{_HELD}] if x is not null], ',') as licenses
from trails
"""

_NEGATIVES = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda c: floor(256 * c::double)) as x
           from embeddings
           where label is not null and embedding is not null
             and len(list_filter(embedding, lambda c: c is not null and isfinite(c))) = len(embedding)),
pairs as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
                 list_dot_product(a.x, b.x)::bigint as score
          from e a join e b on b.vec_id <> a.vec_id and len(a.x) = len(b.x) where a.vec_id % 100 = 0),
positives as (select anchor_id, other as positive_id, score as positive_score from pairs where same
              qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, other))::int as rank,
       other as negative_id, positive_score, score as negative_score
from positives join pairs using (anchor_id)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5
"""

ORACLE: dict[str, str] = {"op2_mix_sources": _MIX, "op10_license_scan": _LICENSES, "op12_hard_negatives": _NEGATIVES}
