"""The operators as registered queries over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, codes, counts, hnsw, jaccard, langid, packing, secrets, suffix, urls, vectors, warc, whitening
from .common import Scratch, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark, sf_dir):
    """Encode every whole text, decode the ids, and return digests of both."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_bpe(docs, *vocabulary, names=["doc_id"])
    back = bpe.decode_bpe(coded, *vocabulary)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_packing(spark, sf_dir):
    """Pack all documents into sequences of 2048 ids."""
    scratch = Scratch(spark, "op2")
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    pieces = scratch.write(packing.row_number_column(pieces), "pieces")
    rest = pieces.where("length < 2048").count()
    return packing.pack(pieces, packing.group_count(rest)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op3_secrets(spark, sf_dir):
    """All secret spans of every whole text."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(secrets.spans_text(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.spans_text(F.col("secret_spans")).alias("spans"))


@query
def op7_language_id(spark, sf_dir):
    """Predict every document's language from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", langid.held_out())
    model = langid.train(docs.where("not held_out"), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs.drop("lang"), model, names=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@query
def op9_warc(spark, sf_dir):
    """Archive every page, then read the archives back."""
    return warc.archive(table(spark, sf_dir, "pages"))[0].select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op9_warc"] = r"""
with p as materialized (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(encode(coalesce(html, ''))) as h from pages),
f as (select h, min(page_id) as first from p group by h having count(*) > 1)
select page_id, cast(n as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((cast('0x' || substr(h, cast(5 * (j // 4) + 1 as integer), 5) as integer) >> cast(15 - 5 * (j % 4) as integer)) & 31) + 1, 1)), '') as payload_digest,
  case when first is null or first = page_id then 'response' else 'revisit' end as record_type, case when first <> page_id then first end as refers_to
from p left join f using (h)"""


@query
def op10_url_filter(spark, sf_dir):
    """Judge every page's url."""
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query
def op8_ngram_jaccard(spark, sf_dir):
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


ORACLE["op8_ngram_jaccard"] = r"""
with recursive w as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') as words from documents),
s as materialized (select doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 1, 2)), lambda i: array_to_string(words[i:i + 2], ' '))) as shingles
  from w where len(words) > 0),
t as materialized (select doc_id, unnest(shingles) as shingle, len(shingles) as n from s),
pairs as (select a.doc_id as x, b.doc_id as y, any_value(a.n) as n, any_value(b.n) as m, count(*) as both_ from t a join t b using (shingle)
  where a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) group by 1, 2),
links as materialized (select x, y from pairs where 100 * both_ >= 90 * (n + m - both_)),
reach as (select x, y from links union select reach.x, links.y from reach join links on reach.y = links.x),
low as (select x as doc_id, min(y) as least_y from reach group by x)
select doc_id, cast(coalesce(len(shingles), 0) as bigint) as n_shingles, least(doc_id, coalesce(least_y, doc_id)) as component_id
from w left join s using (doc_id) left join low using (doc_id)"""


@query
def op6_suffix_dedup(spark, sf_dir):
    """Remove every byte covered by a 200-byte string that also starts elsewhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix.remove_repeats(docs, length=200)
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return out.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.length("kept")).alias("n_removed"),
                      F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_vector_near_dups(spark, sf_dir):
    """Links and components of all embeddings with a cosine of 0.95 or more."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


ORACLE["op4_vector_near_dups"] = r"""
with recursive v as materialized (select row_number() over () as r, vec_id, cast(embedding as double[]) as e from embeddings),
ok as materialized (select * from v where e is not null and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0
  and len(list_filter(e, lambda x: x <> 0)) > 0),
links as materialized (select a.r as x, b.r as y from ok a join ok b on a.r <> b.r and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select r as x, r as y from v union select reach.x, links.y from reach join links on reach.y = links.x),
low as (select x as r, min(vec_id) as component_id from reach join v on v.r = reach.y group by x)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from v join low using (r) left join (select x as r, count(*) as n from links group by x) using (r)"""


@query
def op5_hnsw(spark, sf_dir):
    """The 20 nearest of every embedding whose vec_id is divisible by 20."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op11_whitening(spark, sf_dir):
    """All embeddings projected on the 32 leading components of their covariance, scaled to unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


@query
def op12_vector_codes(spark, sf_dir):
    """Codes of all embeddings by 8 codebooks of 16 entries after 6 rounds."""
    return codes.compress(table(spark, sf_dir, "embeddings"), parts=8, size=16, rounds=6)


def _codes_sql(parts: int = 8, size: int = 16, rounds: int = 6) -> str:
    steps = [f"""
rows as materialized (select row_number() over () as r, vec_id, label,
  list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as q
  from embeddings where embedding is not null
  and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
cells as materialized (select r, vec_id, label, pos // (len(q) // {parts}) as part, pos % (len(q) // {parts}) as place, q[pos + 1] as x
  from rows, range(0, 64) as places(pos)),
first as (select r, row_number() over (order by vec_id) - 1 as entry from rows qualify entry < {size}),
book0 as materialized (select part, entry, place, x as c from cells join first using (r))"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} as materialized (select r, part, min(struct_pack(far := far, entry := entry)) as best from (
  select r, part, entry, sum((x - c) * (x - c)) as far from cells join book{i} using (part, place) group by all) group by all)""")
        if i < rounds:
            steps.append(f"""
book{i + 1} as materialized (select part, entry, place, coalesce(cast((s - ((s % n) + n) % n) // n as bigint), c) as c from book{i} left join (
  select part, best.entry as entry, place, sum(x) as s, count(*) as n from cells join near{i} using (r, part) group by all) using (part, entry, place))""")
    return f"""with {','.join(steps)},
coded as (select r, string_agg(printf('%02x', cast(best.entry as integer)), '' order by part) as code, cast(sum(best.far) as bigint) as error
  from near{rounds} group by r)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(c as varchar), ',' order by part, entry, place)) from book{rounds}) as codebooks_sha256
from coded join rows using (r)"""


ORACLE["op12_vector_codes"] = _codes_sql()


@query
def op13_token_counts(spark, sf_dir):
    """Token counts of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    told = counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id", "n_bytes"])
    return told.select("*", (F.col("n_tokens") > 2048).alias("over_limit"))
