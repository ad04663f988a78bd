"""The queries of this package, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    anchor_simhash,
    block_topk,
    box_tree,
    hashed_maxent,
    license_join,
    line_templates,
    piece_automaton,
    quality_ledger,
    resident_lloyd,
    secret_lexer,
    swap_packing,
    token_counts,
    url_rules,
)

#: The vocabulary that token counts and packing use.
VOCABULARY = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_ledger.build_ledger(table(spark, sf_dir, "documents"))
    judged = quality_ledger.apply_policy(ledger, quality_ledger.STANDARD)
    base = quality_ledger.rejected(F.col("fail_bits"), quality_ledger.BASE)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "n_lines", "fail_bits",
    )


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_topk.top_products(table(spark, sf_dir, "embeddings"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_templates.dedup_rows(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_piece_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text again."""
    model = piece_automaton.read_model(vocabulary(PIECES))
    encoded = piece_automaton.encode(table(spark, sf_dir, "documents"), model)
    decoded = piece_automaton.decode(encoded, model)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op5_secret_lexer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_lexer.find_secrets(table(spark, sf_dir, "documents"))
    listed = F.transform(
        "spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        "base_sha256", F.array_join(listed, ",").alias("spans"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, vocabulary(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(VOCABULARY))


def op8_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_simhash.near_duplicates(table(spark, sf_dir, "documents"))


def license_columns(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"), F.array_max("starts").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


def op9_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_columns(license_join.scan_licenses(table(spark, sf_dir, "documents")))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number at the end of a page's path is that of the document it shows: whose label counts."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(bad, "block").otherwise("allow").alias("label")
    )
    pages = table(spark, sf_dir, "pages")
    path = url_rules.split_url(F.col("url"))[1]
    number = F.regexp_extract(path, r"/(\d{1,18})(?:\.html)?/?\z", 1).try_cast("long")
    shown = pages.select(F.col("page_id").alias("id"), number.alias("doc_id"))
    return url_rules.judge_pages(pages, shown.join(labels, "doc_id").select("id", "label"))


def op11_box_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return box_tree.mine_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op12_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = resident_lloyd.compress(table(spark, sf_dir, "embeddings"))
    return resident_lloyd.label_errors(coded).select(
        "vec_id", resident_lloyd.code_text(F.col("entries")).alias("code"), "error", "label_error",
        F.lit(resident_lloyd.digest(codebooks)).alias("codebooks_sha256"),
    )


def lloyd_sql() -> str:
    """Four rounds over all parts and entries, one after the other."""
    rounds = ""
    for r in range(resident_lloyd.ROUNDS + 1):
        rounds += f"""
), found{r} as materialized (
    select p.uid, p.pos,
           min(struct_pack(d := list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v)
                                + list_inner_product(c.v, c.v), e := c.entry)) as near
    from parts p join books{r} c on p.pos = c.pos group by p.uid, p.pos"""
        if r < resident_lloyd.ROUNDS:
            rounds += f"""
), sums{r} as (
    select pos, entry, i, floor(sum(x) / count(*)) as x
    from (select p.pos, f.near.e as entry, unnest(p.v) as x, generate_subscripts(p.v, 1) as i
          from parts p join found{r} f on p.uid = f.uid and p.pos = f.pos)
    group by pos, entry, i
), means{r} as (
    select pos, entry, list(x order by i) as v from sums{r} group by pos, entry
), books{r + 1} as materialized (
    select b.pos, b.entry, coalesce(m.v, b.v) as v
    from books{r} b left join means{r} m on b.pos = m.pos and b.entry = m.entry"""
    last = resident_lloyd.ROUNDS
    return f"""
with kept as (
    select vec_id, label, row_number() over (order by vec_id) - 1 as uid,
           list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
    from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
    select uid, pos, v[pos * (len(v) // 4) + 1 : (pos + 1) * (len(v) // 4)] as v
    from kept, (values (0), (1), (2), (3)) as p(pos)
), books0 as materialized (
    select pos, uid as entry, v from parts where uid < 256{rounds}
), hashed as (
    select sha256(string_agg(array_to_string(list_transform(v, lambda x: cast(x as bigint)), ','), ','
                             order by pos, entry)) as h
    from books{last}
), coded as (
    select uid, string_agg(lpad(lower(to_hex(near.e)), 2, '0'), '' order by pos) as code,
           cast(sum(near.d) as bigint) as error
    from found{last} group by uid
)
select k.vec_id, c.code, c.error,
       cast(sum(c.error) over (partition by k.label) as bigint) as label_error,
       h as codebooks_sha256
from kept k join coded c on k.uid = c.uid cross join hashed
"""


def op13_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    learns = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    scored = hashed_maxent.score_documents(table(spark, sf_dir, "documents"), learns)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_ledger": op1_quality_ledger,
    "op2_block_topk": op2_block_topk,
    "op3_line_templates": op3_line_templates,
    "op4_piece_automaton": op4_piece_automaton,
    "op5_secret_lexer": op5_secret_lexer,
    "op6_token_counts": op6_token_counts,
    "op7_swap_packing": op7_swap_packing,
    "op8_anchor_simhash": op8_anchor_simhash,
    "op9_license_join": op9_license_join,
    "op10_url_rules": op10_url_rules,
    "op11_box_tree": op11_box_tree,
    "op12_resident_lloyd": op12_resident_lloyd,
    "op13_hashed_maxent": op13_hashed_maxent,
}

ORACLES: dict[str, str] = {
    "op1_quality_ledger": r"""
with texts as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
    from documents
), placed as (
    select doc_id, unnest(words) as w, generate_subscripts(words, 1) as i from texts
), windows as (
    select doc_id, i, w as a, lead(w) over p as b, lead(w, 2) over p as c
    from placed window p as (partition by doc_id order by i)
), again as (
    select doc_id, i, count(*) over (partition by doc_id, a, b, c) as times
    from windows where c is not null
), repeated as (
    select doc_id, count(distinct i + d) as n
    from again, (values (0), (1), (2)) as s(d) where times > 1 group by doc_id
), measured as (
    select t.doc_id, cast(len(words) as bigint) as n_words,
           cast(length(array_to_string(words, '')) as bigint) as word_chars,
           cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
           cast(len(lines) as bigint) as n_lines,
           cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
           cast(coalesce(r.n, 0) as bigint) as n_repeat_words
    from texts t left join repeated r on t.doc_id = r.doc_id
), bits as (
    select *, n_words < 50 as f0, 100 * n_repeat_words > 50 * n_words as f1,
           10 * n_symbols > n_words as f2, 2 * n_dup_lines > n_lines as f3,
           word_chars < 2 * n_words as f4, word_chars > 15 * n_words as f5
    from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
       f0 or f1 as base_failed, not (f0 or f1 or f2 or f3 or f4 or f5) as kept,
       cast(f0::int + 2 * f1::int + 4 * f2::int + 8 * f3::int + 16 * f4::int + 32 * f5::int
            as bigint) as fail_bits
from bits
""",
    "op2_block_topk": """
with whole as (
    select vec_id,
           list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id,
           cast(list_inner_product(q.v, c.v) as bigint) as score
    from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
    from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
""",
    "op3_line_templates": r"""
with lines as (
    select doc_id, unnest(string_split(text, chr(10))) as line,
           generate_subscripts(string_split(text, chr(10)), 1) as place
    from documents
), tokens as (
    select doc_id, line, place,
           list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda t: t <> '') as raw
    from lines
), masked as (
    select *, len(raw) as n,
           list_transform(raw, lambda t: case when regexp_matches(t, '[0-9]') then '<*>' else t end) as ts,
           list_transform(raw, lambda t: cast(not regexp_matches(t, '[0-9]') and regexp_matches(t, '\p{L}') as int)) as ws
    from tokens where len(raw) >= 3
), numbered as (
    select *, 3 + (n - 3) * j // 4 as low, 3 + (n - 3) * (j + 1) // 4 as high, coalesce(list_sum(ws), 0) as words
    from masked, (values (-1), (0), (1), (2), (3)) as parts(j)
    where j = -1 or n >= 11
), templates as (
    select doc_id, place,
           case when j >= 0 then ts[:low] || ['<part>'] || ts[high + 1:]
                when regexp_matches(line, '[0-9]') and not (words >= 2 and words * 3 >= n) then raw
                else ts end as template,
           n, case when j = -1 and regexp_matches(line, '[0-9]') and not (words >= 2 and words * 3 >= n)
                   then -2 else j end as j
    from (select *, words - coalesce(list_sum(ws[low + 1 : high]), 0) as kept from numbered)
    where j = -1 or (kept >= 2 and kept * 3 >= n)
), recurring as (
    select template, n, j, min(struct_pack(d := doc_id, a := place)) as first
    from templates group by template, n, j having count(distinct doc_id) >= 2
), dropped as (
    select distinct t.doc_id, t.place
    from templates t join recurring r on t.template = r.template and t.n = r.n and t.j = r.j
    where struct_pack(d := t.doc_id, a := t.place) <> r.first
), texts as (
    select l.doc_id, count(*) as n_lines, count(d.place) as n_dropped,
           coalesce(string_agg(l.line, chr(10) order by l.place) filter (where d.place is null), '') as kept
    from lines l left join dropped d on l.doc_id = d.doc_id and l.place = d.place
    group by l.doc_id
)
select d.doc_id, coalesce(t.n_lines, 0) as n_lines, coalesce(t.n_dropped, 0) as n_dropped,
       sha256(t.kept) as kept_sha256
from documents d left join texts t on d.doc_id = t.doc_id
""",
    "op11_box_tree": """
with whole as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
           cast(list_inner_product(a.v, c.v) as bigint) as score
    from whole a join whole c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id
                               order by n.score desc, n.vec_id) as integer) as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
 and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score
qualify rank <= 10
""",
    "op12_resident_lloyd": lloyd_sql(),
}
