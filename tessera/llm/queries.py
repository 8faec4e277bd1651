"""The queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

from tessera.llm.exact import op10_exact_cuckoo
from tessera.llm.importance import BUCKETS, LEAST_WORDS, PERCENT, SEED as DRAW_SEED, op13_importance_resampling
from tessera.llm.mixing import BLOCK_WORDS, SEED, SHARD_SIZES, op8_sainte_lague_mix
from tessera.llm.packing import op5_harmonic_packing
from tessera.llm.phrases import COVER, LEAST, TOP, op11_phrase_filters
from tessera.llm.quality import op9_attention_quality
from tessera.llm.rules import op6_risk_controlled_rules
from tessera.llm.scoring import op2_suffix_tree_score
from tessera.llm.sharding import op7_tiered_compaction
from tessera.llm.simhash import op3_simhash_golay
from tessera.llm.suffix import op4_repeat_removal
from tessera.llm.token_counts import op12_token_counts
from tessera.llm.tokens import op1_token_files

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_suffix_tree_score": op2_suffix_tree_score,
    "op3_simhash_golay": op3_simhash_golay,
    "op4_repeat_removal": op4_repeat_removal,
    "op5_harmonic_packing": op5_harmonic_packing,
    "op6_risk_controlled_rules": op6_risk_controlled_rules,
    "op7_tiered_compaction": op7_tiered_compaction,
    "op8_sainte_lague_mix": op8_sainte_lague_mix,
    "op9_attention_quality": op9_attention_quality,
    "op10_exact_cuckoo": op10_exact_cuckoo,
    "op11_phrase_filters": op11_phrase_filters,
    "op12_token_counts": op12_token_counts,
    "op13_importance_resampling": op13_importance_resampling,
}
#: A-Z lower-cased and nothing else, in DuckDB.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DIGITS = "case " + " ".join(f"when source_size < {most} then {n}" for n, most in enumerate(SHARD_SIZES, 2)) + f" else {len(SHARD_SIZES) + 2} end"

#: Every seat of every member is a row here; the highest quotients win.
MIX = rf"""
    with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
                      md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as place from documents),
    s0 as (select source, cast(sum(size) as bigint) as source_size from d group by 1),
    s1 as (select *, 3 * source_size as most, [5, 2, 1][(row_number() over (order by source asc nulls last) - 1) % 3 + 1] as weight from s0),
    s2 as (select *, cast(sum(source_size) over () as bigint) as total,
                  cast(coalesce(sum(most) over (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as bigint) as used,
                  cast(sum(weight) over () - coalesce(sum(weight) over (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as bigint) as weights from s1),
    s3 as (select *, (total - used) / weights as level from s2),
    s4 as (select *, (select level from s3 where most / weight >= level order by most / weight, level limit 1) as share from s3),
    s5 as (select source, source_size, least(cast(most as double), share * weight) as target from s4),
    s6 as (select *, cast(round(sum(target) over () / {BLOCK_WORDS}) as bigint) as seats from s5),
    s7 as (select source, row_number() over (order by target / (2.0 * k + 1.0) desc, source nulls last) as place, seats
           from (select *, unnest(range(seats + 1)) as k from s6 where target > 0)),
    s8 as (select source, count(*) as blocks from s7 where place <= seats group by 1),
    s9 as (select s5.*, coalesce(blocks, 0) as blocks from s5 left join s8 on s5.source is not distinct from s8.source),
    p as (select d.*, place[1:{_DIGITS}] as shard from d join s0 on d.source is not distinct from s0.source),
    c0 as (select source, shard, cast(sum(size) as bigint) as words from p group by 1, 2 having sum(size) > 0),
    c1 as (select c0.*, blocks from c0 join s9 on c0.source is not distinct from s9.source),
    c2 as (select source, shard, blocks, row_number() over (partition by source order by words / (2.0 * k + 1.0) desc, shard) as place
           from (select *, unnest(range(blocks + 1)) as k from c1)),
    c3 as (select source, shard, count(*) as quota from c2 where place <= blocks group by 1, 2),
    c4 as (select c1.*, least(coalesce(quota, 0) * {BLOCK_WORDS}, 3 * words) as quota, cast('0x' || md5('{SEED}:' || coalesce(c1.source, '') || ':' || c1.shard)[1:8] as bigint) as seed
           from c1 left join c3 on c1.source is not distinct from c3.source and c1.shard = c3.shard),
    c5 as (select source, shard, words, quota // words as whole, quota % words as more, seed % ((words + {BLOCK_WORDS} - 1) // {BLOCK_WORDS}) * {BLOCK_WORDS} as first from c4),
    r as (select *, cast(coalesce(sum(size) over (partition by source, shard order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0) as bigint) as a from p)
    select doc_id, size, source_size, target,
           cast(coalesce(whole * size + greatest(0, least(a + size, least(first + more, words)) - greatest(a, first)) + greatest(0, least(a + size, first + more - words) - a), 0) as bigint) as taken
    from r left join c5 on r.source is not distinct from c5.source and r.shard = c5.shard join s9 on r.source is not distinct from s9.source"""

PHRASES = rf"""
    with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\n\x0B\f\r]')) as piece from documents),
    w as (select lang, regexp_extract_all(piece, '[^ \t]+') as w from p),
    g as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
    f as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, any_value(w[i:i + k - 1]) as ws, count(*) as f
          from (select *, unnest(range(1, 4)) as k from g) where i + k - 1 <= len(w) group by all),
    n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by 1),
    c as (select lang, k, phrase, ws, f as a from f where k > 1 and f >= {LEAST}),
    s as (select c.*, cut, x.f as l, y.f as r, 1000000::hugeint * a * a // (x.f::hugeint * y.f) as score
          from (select *, unnest(range(1, k)) as cut from c) c
          join f x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1:cut], ' ') join f y on y.lang = c.lang and y.phrase = array_to_string(c.ws[cut + 1:c.k], ' ')),
    b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
    o as (select distinct c.lang, array_to_string(c.ws[i:i + 1], ' ') as phrase, max(a) as longer from (select *, unnest(range(1, 3)) as i from c where k = 3) c group by 1, 2),
    d as (select b.* from b left join o on k = 2 and b.lang = o.lang and b.phrase = o.phrase where longer is null or 100 * longer < {COVER} * a)
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score
    from d join n using (lang) qualify rank <= {TOP}"""

#: The checksum byte by byte, its table of 256 entries from the polynomial.
RESAMPLE = rf"""
    with c as (select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from range(256) r(i)),
    w as (select doc_id, unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from documents),
    b as (select unnest(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
    v as (select distinct word, hex(encode(word)) as x from (select word from w union all select word from b)),
    k as (select word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda j: 16 * (instr('0123456789ABCDEF', x[2 * j + 1]) - 1) + instr('0123456789ABCDEF', x[2 * j + 2]) - 1)),
                 lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % {BUCKETS} as bucket from v, c),
    s as (select bucket, count(*) as s from w join k using (word) group by 1),
    t as (select bucket, count(*) as t from b join k using (word) group by 1),
    g as (select r.bucket, floor(1000 * ln(cast(coalesce(t, 0) + 1 as double) * ((select count(*) from w) + {BUCKETS}) / (cast(coalesce(s, 0) + 1 as double) * ((select count(*) from b) + {BUCKETS})))) as gain
          from range({BUCKETS}) r(bucket) left join s using (bucket) left join t using (bucket)),
    d as (select doc_id, count(*) as n_features, cast(sum(gain) as bigint) as weight from w join k using (word) join g using (bucket) group by 1),
    e as (select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, cast('0x' || sha256('{DRAW_SEED}:' || doc_id)[1:8] as bigint) as h from documents left join d using (doc_id)),
    f as (select doc_id, n_features, weight, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score, n_features >= {LEAST_WORDS} as able from e),
    r as (select *, row_number() over (partition by able order by score desc, doc_id) as place, count(*) filter (able) over () as n from f)
    select doc_id, n_features, weight, score, case when able and place <= {PERCENT} * n // 100 then place end as rank from r"""

SQL: dict[str, str] = {
    "op11_phrase_filters": PHRASES,
    "op13_importance_resampling": RESAMPLE,
    "op7_tiered_compaction": "select doc_id, source, lang, cast(strlen(text) as bigint) as n_bytes, sha256(text) as text_sha256 from documents",
    "op8_sainte_lague_mix": MIX,
    "op10_exact_cuckoo": f"""
        with d as (select doc_id, sha256({LOWER}) as text_sha256 from documents),
             g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by 1)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)""",
}
