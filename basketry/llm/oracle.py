"""DuckDB SQL for the queries of this subpackage that SQL can express; the others are tested by brute force."""

from __future__ import annotations

OP1 = r"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), worded as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from docs
), windows as (
  select r, unnest(range(1, greatest(len(w) - 1, 1))) as i, w from worded
), counted as (
  select r, i, count(*) over (partition by r, w[i], w[i + 1], w[i + 2]) as n from windows
), repeated as (
  select r, count(distinct p) as n_repeat_words
  from (select r, unnest([i, i + 1, i + 2]) as p from counted where n > 1) group by r
), measured as (
  select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(l)::bigint as n_lines, len(regexp_extract_all(text, '[A-Z]'))::bigint as n_capitals
  from worded left join repeated using (r)
), ledger as (
  select *, (n_words < 50)::bigint * 1 + (100 * n_repeat_words > 50 * n_words)::bigint * 2
    + (100 * n_symbols > 10 * word_chars)::bigint * 4
    + (n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines)::bigint * 8
    + (100 * n_capitals > 40 * word_chars)::bigint * 16
    + (word_chars > 40 * n_words or 2 * word_chars < 3 * n_words)::bigint * 32 as failed
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 as base_failed,
  failed = 0 as kept, failed, n_lines, n_capitals
from ledger
"""

MODULO = "18446744073709551616::uhugeint"


def _times(a: str, b: str) -> str:
    """Product modulo 2^64."""
    return f"((({a})::uhugeint * {b}::uhugeint) % {MODULO})::ubigint"


OP2 = f"""
with recursive polynomial as (
  select n, 0 as k, n::bigint as c from range(256) t(n)
  union all
  select n, k + 1, case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end from polynomial where k < 8
), steps as (
  select list(c order by n) as step from polynomial where k = 8
), docs as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as body,
    ((coalesce(doc_id, -9223372036854775808)::hugeint + 18446744073709551616) % 18446744073709551616)::ubigint as key
  from documents
), sized as (
  select r, doc_id, key, length(body) // 2 + 16 as size,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, [('0x' || body[2 * i - 1:2 * i])::bigint for i in range(1, length(body) // 2 + 1)]),
      lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1]))) as text_crc32
  from docs, steps
), mixed1 as (
  select r, {_times("xor(key, key >> 30)", "13787848793156543929")} as z from docs
), mixed2 as (
  select r, {_times("xor(z, z >> 27)", "10723151780598845931")} as z from mixed1
), jumps as (
  select r, xor(z, z >> 31) as state, 0::bigint as j from mixed2
  union all
  select r, state, floor((j + 1) * (2147483648.0::double / ((state >> 33) + 1)::double))::bigint as j
  from (select r, (({_times("state", "2862933555777941757")}::uhugeint + 1) % {MODULO})::ubigint as state, j from jumps where j < 41)
), shards as (
  select r, max(j) filter (j < 40)::integer as shard, max(j) filter (j < 41)::integer as grown_shard from jumps group by r
)
select doc_id, size, text_crc32, 'key' as law, shard,
  row_number() over (partition by shard order by doc_id nulls first, size, text_crc32) - 1 as slot, grown_shard
from sized join shards using (r)
"""

OP3 = r"""
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    -ln((('0x' || md5('7:' || coalesce(doc_id::varchar, 'null') || ':' || coalesce(text, ''))[1:12])::bigint::double + 0.5)
      / 281474976710656.0::double)
    / greatest(0.05::double, 1.0::double - 10.0::double * len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))
      / greatest(length(coalesce(text, '')), 1)) as key
  from documents
), sources as (
  select source, sum(size)::bigint as s, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w from rows group by source
), filling as (
  select *, sum(3 * s) over o - 3 * s as most_before, sum(w) over o - w as w_before, sum(s) over () as total, sum(w) over () as weights
  from sources window o as (order by s * (6 // w), source nulls last rows unbounded preceding)
), level as (
  select (total - most_before)::double as l, (weights - w_before)::double as w from filling
  where not (3 * s * (weights - w_before) < w * (total - most_before)) order by s * (6 // w), source nulls last limit 1
), targets as (
  select source, s as source_size, case when total = 0 then 0.0::double
    else least((3 * s)::double, filling.w::double * l / level.w) end as target
  from filling left join level on true
), placed as (
  select *, sum(size) over (partition by source order by key, doc_id rows unbounded preceding) - size as before from rows
), decided as (
  select doc_id, size, source_size, target, p.source,
    (case when source_size > 0 then floor(target / source_size) else 0 end)::bigint as epochs, before
  from placed p join targets t on p.source is not distinct from t.source
), chosen as (
  select *, size > 0 and 2 * before + size <= 2 * (target - epochs * source_size) as chosen from decided
)
select doc_id, size, source_size, target, (size * (epochs + chosen::bigint))::bigint as taken, source, epochs, chosen from chosen
"""

FACTORS = [pow(48271, r + 1, (1 << 31) - 1) for r in range(16)]

OP11 = rf"""
with docs as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n_chars from documents
), followed as (
  select *, coalesce(lead(text) over o, first_value(text) over o) as following from docs window o as (order by doc_id nulls first)
), changed as (
  select *, text[1:n_chars - n_chars // 4] || following[1:n_chars // 4] as edited from followed
), versions as (
  select doc_id, 0 as version, text from changed union all select doc_id, 1, edited from changed
), worded as (
  select doc_id, version, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from versions
), occurring as (
  select distinct doc_id, version, unnest(w) as term from worded
), lexicon as (
  select term, ('0x' || md5(term)[1:15])::bigint % 2147483646 + 1 as code
  from (select term, count(*) as df from occurring where version = 0 group by term), (select count(*) as n from docs)
  where df * 16 <= n and df * 2048 >= n and df >= 2
), coded as (
  select doc_id, version, list(code) as codes from occurring join lexicon using (term) group by doc_id, version
), chains as (
  select doc_id, version, codes, unnest(range(1, 17)) as r, unnest({FACTORS}::bigint[]) as f from coded
), limited as (
  select doc_id, version, r, list_transform(codes, lambda c: {{'c': c, 'v': c * f % 2147483647}}) as codes,
    1::bigint << length(bin(list_min(list_transform(codes, lambda c: c * f % 2147483647))))::bigint as below from chains
), parts as (
  select doc_id, version,
    string_agg(md5(array_to_string(list_sort(list_transform(list_filter(codes, lambda x: x.v < below), lambda x: x.c)), ' '))[1:8], '-' order by r) as chained
  from limited group by doc_id, version
), printed as (
  select doc_id, version, case when codes is not null then md5(array_to_string(list_sort(codes), ' '))[1:16] || '-' || chained
    else array_to_string(list_prepend(whole[1:16], list_transform(range(16), lambda i: whole[1:8])), '-') end as fingerprint
  from (select *, case when codes is null
      then md5(array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ')) end as whole
    from worded left join coded using (doc_id, version)) left join parts using (doc_id, version)
), paired as (
  select c.doc_id, c.n_chars::bigint as n_chars, sha256(c.edited) as edited_sha256, a.fingerprint, b.fingerprint as edited_fingerprint
  from changed c join printed a on a.doc_id = c.doc_id and a.version = 0 join printed b on b.doc_id = c.doc_id and b.version = 1
), after as (
  select *, coalesce(lead(fingerprint) over o, first_value(fingerprint) over o) as next_fingerprint from paired window o as (order by doc_id nulls first)
)
select doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  len(list_filter(list_zip(string_split(fingerprint, '-'), string_split(edited_fingerprint, '-')), lambda z: z[1] = z[2]))::double / 17 as near_edited,
  len(list_filter(list_zip(string_split(fingerprint, '-'), string_split(next_fingerprint, '-')), lambda z: z[1] = z[2]))::double / 17 as near_next
from after
"""


def _round(k: int) -> str:
    """The nearest centroid of each vector in round ``k``, and the centroids after it."""
    return f"""
), d{k} as (
  select r, cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as distance from kept v, c{k} c
), a{k} as (
  select r, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance from d{k} group by r
), s{k} as (
  select cluster, i, sum(x)::bigint as s, count(*) as n
  from (select cluster, unnest(range(1, 65)) as i, unnest(x) as x from a{k} join kept using (r)) group by cluster, i
), m{k} as (
  select cluster, list((s - ((s % n) + n) % n) // n order by i) as x from s{k} group by cluster
), c{k + 1} as (
  select cluster, coalesce(m.x, c.x) as x from c{k} c left join m{k} m using (cluster)"""


OP13 = f"""
with kept as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda e: floor(64 * e::double)::bigint) as x
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64
), c0 as (
  select row_number() over (order by draw) - 1 as cluster, x
  from (select sha256('1:' || vec_id::varchar) as draw, x from kept order by draw nulls last limit 16){"".join(_round(k) for k in range(4))}
)
select vec_id, cluster::integer as cluster, distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia,
  sum(distance) over ()::bigint as inertia, sha256(array_to_string(c3.x, ',')) as centroid_sha256
from a3 join kept using (r) join c3 using (cluster)
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op2_jump_sharding": OP2,
    "op3_source_mixing": OP3,
    "op11_document_fingerprints": OP11,
    "op13_centroid_clustering": OP13,
}
