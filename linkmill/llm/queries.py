"""The registered query of each operator and, where SQL can express it, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm import (
    chosen_path,
    decontam,
    dual_tree,
    exact_dedup,
    fair_mix,
    html_blocks,
    lang_id,
    lookup_centroids,
    part_enum,
    pii,
    token_counts,
    url_cascade,
    warc,
)

#: where the public vocabulary files lie on the driver
TOKENIZER_FOLDER = "/opt/tokenizers"
VOCABULARY = f"{TOKENIZER_FOLDER}/byte_bpe_50k.tiktoken"
#: fixed value: the pre-token pattern that belongs to the vocabulary
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extract(_table(spark, folder, "pages"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    edits = token_counts.edits_for(F.col("doc_id"), F.col("text"))
    return token_counts.count_edited(docs, edits, VOCABULARY, PRE_TOKENS)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.drop("items")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, folder, "documents"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.told_spans(pii.find_personal_data(_table(spark, folder, "documents")))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    judged = url_cascade.judge_urls(pages, url_cascade.labelled_hosts(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_fair_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = fair_mix.mix_by_weight(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_similar_groups(spark: SparkSession, folder: str) -> DataFrame:
    return part_enum.similar_groups(_table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages")).drop("payload")


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = lang_id.identify(docs, lang_id.train(docs), keep=["doc_id"])
    return found.select("doc_id", lang_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_dual_tree_codes(spark: SparkSession, folder: str) -> DataFrame:
    return dual_tree.compress(_table(spark, folder, "embeddings"))


def op12_lookup_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return lookup_centroids.cluster(_table(spark, folder, "embeddings"))


def op13_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.similar_groups(_table(spark, folder, "documents"))


_WORD_RX = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = rf"""
with d as materialized (select row_number() over () as r, doc_id,
            coalesce(regexp_extract_all({_LOWER.format("text")}, '{_WORD_RX}'), []::varchar[]) as w from documents),
b as (select item_id, regexp_extract_all({_LOWER.format("text")}, '{_WORD_RX}') as w from benchmark where text is not null),
items as (select item_id, w, least(len(w), 10) as n from b where len(w) > 0),
spots as (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from items),
wins as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as span from spots),
lens as (select distinct n from wins),
places as (select r, n, w, unnest(range(1, len(w) - n + 2)) as i from d, lens where len(w) >= n),
spans as (select r, n, i, array_to_string(w[i:i + n - 1], ' ') as span from places),
hits as (select r, i, n, item_id from spans join wins using (n, span)),
words as (select r, count(distinct p) as n_hit
          from (select r, unnest(range(i, i + n)) as p from hits) group by r),
named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items
          from (select distinct r, coalesce(cast(item_id as varchar), '') as item from hits) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join named using (r)
"""

_OP4 = r"""
with d as (select doc_id, length(coalesce(text, '')) as n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
k as (select *, first_value(doc_id) over best as keep_id, row_number() over best = 1 as kept,
             count(*) over (partition by text_sha256) as group_size
      from d window best as (partition by text_sha256 order by n desc, doc_id nulls last))
select doc_id, keep_id, group_size, kept, text_sha256 from k
"""

_OP6 = r"""
with p as (select page_id,
                  case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) else '' end as h,
                  case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) else '' end as path
           from pages),
q as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from p),
r as (select *, case
        when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
        when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
        when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule from q)
select page_id, host, path, rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
            when list_has_any(string_split(host, '.'), ['spam-farm', 'cheap-pills', 'casino-win']) then 'block'
            else 'allow' end as verdict
from r
"""

_OP7 = r"""
with recursive d as (
  select doc_id, source, cast(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), '')) as place from documents),
s as (select source, cast(sum(size) as bigint) as source_size,
             case (row_number() over (order by source is null, source) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
      from d group by source),
o as (select *, row_number() over (order by source_size / weight, source is null, source) as k from s),
fill as (
  select 0 as k, cast((select sum(source_size) from s) as bigint) as words_left, cast((select sum(weight) from s) as bigint) as weight_left
  union all
  select f.k + 1, f.words_left - 3 * o.source_size, f.weight_left - o.weight
  from fill f join o on o.k = f.k + 1 where 3 * o.source_size * f.weight_left < f.words_left * o.weight),
done as (select k, words_left, weight_left from fill order by k desc limit 1),
t as (select source, source_size, case when o.k <= done.k then cast(3 * source_size as double)
                                  else cast(weight * words_left as double) / weight_left end as target from o, done),
q as (select d.*, t.source_size, t.target,
             sum(d.size) over (partition by d.source order by place, size, doc_id rows between unbounded preceding and current row) as sent
      from d join t on d.source is not distinct from t.source),
f as (select *, (sent + c * source_size) / target as finish from q, (select unnest([0, 1, 2]) as c) where size > 0),
g as (select *, sum(size) over (order by finish, source is null, source, sent, c rows between unbounded preceding and current row) - size as used from f),
took as (select source, sent, sum(greatest(least(size, (select sum(size) from d) - used), 0)) as taken from g group by source, sent)
select q.doc_id, q.size, q.source_size, q.target, cast(coalesce(taken, 0) as bigint) as taken
from q left join took on q.source is not distinct from took.source and q.sent = took.sent and q.size > 0
"""

_OP9 = r"""
with p as (select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
                  sha1(coalesce(html, '')) as payload_digest from pages),
f as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as first from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id is distinct from first then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id is distinct from first then first end as refers_to
from f
"""

_PLAIN = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _op11() -> str:
    """Two rounds and a last assignment as chained tables; parts of four components."""
    cells = ", ".join(f"x{k}" for k in range(4))
    far = " + ".join(f"(a.x{k} - b.x{k}) * (a.x{k} - b.x{k})" for k in range(4))
    mean = ", ".join(f"cast(floor(cast(sum(a.x{k}) as double) / count(*)) as bigint) as x{k}" for k in range(4))
    kept = ", ".join(f"coalesce(m.x{k}, c.x{k}) as x{k}" for k in range(4))
    listed = " || ',' || ".join(f"x{k}" for k in range(4))
    steps = [
        f"""with v as materialized (select vec_id, label, embedding, row_number() over (order by vec_id) - 1 as r
                from embeddings where {_PLAIN}),
q as materialized (select r, p, {", ".join(f"cast(floor(256 * cast(embedding[p * 4 + {k + 1}] as double)) as bigint) as x{k}" for k in range(4))}
                   from v, (select unnest(range(16)) as p)),
c0 as materialized (select p, r as e, {cells} from q where r < 64)"""
    ]
    for n in range(3):
        steps.append(
            f"a{n} as materialized (select a.r, a.p, min(({far}) * 64 + b.e) as best from q a join c{n} b using (p) group by a.r, a.p)"
        )
        if n < 2:
            steps.append(
                f"m{n} as (select a.p, best % 64 as e, {mean} from q a join a{n} using (r, p) group by a.p, best % 64),\n"
                f"c{n + 1} as materialized (select c.p, c.e, {kept} from c{n} c left join m{n} m on m.p = c.p and m.e = c.e)"
            )
    steps.append("t as (select r, string_agg(printf('%02x', best % 64), '' order by p) as code, cast(sum(best // 64) as bigint) as error from a2 group by r)")
    return ",\n".join(steps) + f"""
select vec_id, code, error, label, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg({listed}, ',' order by p, e)) from c2) as codebooks_sha256
from v join t using (r)"""


def _op12() -> str:
    """Ten rounds and a last assignment as chained tables of cells."""
    steps = [
        f"""with v as materialized (select vec_id, row_number() over (order by sha256('3:' || vec_id), vec_id) - 1 as r, embedding
                from embeddings where {_PLAIN} and len(embedding) = 64),
q as materialized (select r, k, cast(floor(1024 * cast(embedding[k] as double)) as bigint) as x from v, (select unnest(range(1, 65)) as k)),
c0 as materialized (select r as c, k, x from q where r < 8)"""
    ]
    for n in range(11):
        steps.append(
            f"d{n} as (select q.r, c, sum((q.x - b.x) * (q.x - b.x)) as far from q join c{n} b using (k) group by q.r, c),\n"
            f"a{n} as materialized (select r, min(far * 8 + c) as best from d{n} group by r)"
        )
        if n < 10:
            steps.append(
                f"m{n} as (select best % 8 as c, k, cast(floor(cast(sum(x) as double) / count(*)) as bigint) as x from q join a{n} using (r) group by best % 8, k),\n"
                f"c{n + 1} as materialized (select c, k, coalesce(m.x, b.x) as x from c{n} b left join m{n} m using (c, k))"
            )
    return ",\n".join(steps) + """,
h as (select c, sha256(string_agg(x, ',' order by k)) as centroid_sha256 from c10 group by c),
t as (select r, cast(best % 8 as int) as cluster, cast(best // 8 as bigint) as distance from a10)
select vec_id, cluster, distance, cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia, centroid_sha256
from v join t using (r) join h on h.c = t.cluster"""


QUERIES = {
    "op1_html_blocks": (op1_html_blocks, None),
    "op2_token_counts": (op2_token_counts, None),
    "op3_decontamination": (op3_decontamination, _OP3),
    "op4_exact_dedup": (op4_exact_dedup, _OP4),
    "op5_personal_data": (op5_personal_data, None),
    "op6_url_filters": (op6_url_filters, _OP6),
    "op7_fair_mix": (op7_fair_mix, _OP7),
    "op8_similar_groups": (op8_similar_groups, None),
    "op9_warc": (op9_warc, _OP9),
    "op10_language": (op10_language, None),
    "op11_dual_tree_codes": (op11_dual_tree_codes, _op11()),
    "op12_lookup_centroids": (op12_lookup_centroids, _op12()),
    "op13_chosen_path": (op13_chosen_path, None),
}
