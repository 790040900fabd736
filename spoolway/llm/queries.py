"""The registered queries of this subpackage and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from spoolway.llm import bytecnn, chunks, collocations, contentsort, latent, packing, ppm, prefixtrie, ruleensemble, sharding, simhash, textstats, tokencount, weakrules
from spoolway.llm.common import remainder, stored, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = latent.with_leaks(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("leaks", lambda x: x["item_id"]))
    return found.select(
        "row.doc_id",
        "n_windows",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").alias("n_items"),
        items.alias("item_ids"),
        F.round(F.array_max(F.transform("leaks", lambda x: x["lcs"])), 6).alias("best_lcs"),
    )


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.dedup_substrings(documents(spark, sf_dir).select("doc_id", "text"))
    cut = F.aggregate("dedup.spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "dedup.n_chunks",
        "dedup.n_dup_chunks",
        F.size("dedup.spans").alias("n_spans"),
        cut.alias("removed_bytes"),
        "dedup.spans",
        F.crc32(F.coalesce("dedup.kept_text", F.lit("")).cast("binary")).alias("kept_crc32"),
    )


def op3_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.col("doc_id")
    stats = textstats.with_stats(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    stats = stored(stats, "stats")
    learned = table(spark, sf_dir, "labels").where(remainder(doc_id, 5) != 0)
    model = ruleensemble.fit(stats, learned)
    scored = stats.withColumn("score", model.score(textstats.ratios()))
    return scored.select(
        "doc_id",
        (remainder(doc_id, 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = ppm.with_scores(docs, remainder(F.col("doc_id"), 7) != 2)
    return found.select(
        "row.doc_id",
        (remainder(F.col("row.doc_id"), 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op8_ragged_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = tokencount.with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    network = bytecnn.fit(docs, remainder(F.col("doc_id"), 4) != 2)
    found = bytecnn.with_language(docs.select("doc_id", "text"), network)
    return found.select("row.doc_id", (remainder(F.col("row.doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = weakrules.scored(docs, drop=("text",))
    counts = [F.col(f"stats.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return found.select("doc_id", *counts, weakrules.base_failed().alias("base_failed"), "kept", "quality", "votes")


def op5_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contentsort.with_groups(documents(spark, sf_dir).select("doc_id", "text"), carry=["doc_id"])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = prefixtrie.rebuilt(prefixtrie.digested(table(spark, sf_dir, "conversations")))
    return prefixtrie.prefix_trie(turns, convs).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir).select("lang", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_latent_decontamination": op1_latent_decontamination,
    "op2_chunk_dedup": op2_chunk_dedup,
    "op3_lpt_shards": op3_lpt_shards,
    "op4_simhash": op4_simhash,
    "op5_length_buckets": op5_length_buckets,
    "op6_rule_ensemble": op6_rule_ensemble,
    "op7_ppm": op7_ppm,
    "op8_ragged_bpe": op8_ragged_bpe,
    "op9_weak_rules": op9_weak_rules,
    "op10_byte_cnn": op10_byte_cnn,
    "op11_content_sort": op11_content_sort,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
    "pipeline": pipeline,
}
ORACLE: dict[str, str] = {
    "op11_content_sort": r"""
        with normal as (
          select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
          doc_id = min(doc_id) over same as kept, sha256(norm) as text_sha256
        from normal window same as (partition by norm)
    """,
    "op12_prefix_trie": r"""
        with turns as (
          select conv_id, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} as said
          from conversations where conv_id is not null),
        convs as (
          select conv_id, conv_id::varchar as digits, list(said order by turn nulls first) as own from turns group by conv_id),
        opened as (
          select *, conv_id - conv_id % 5 as base,
            xor(4294967295, list_reduce(list_concat([4294967295::bigint], range(0, 8 * length(digits))), lambda crc, bit:
              xor((case when bit % 8 = 0 then xor(crc, ascii(digits[bit // 8 + 1])::bigint) else crc end) // 2,
                  (case when bit % 8 = 0 then xor(crc, ascii(digits[bit // 8 + 1])::bigint) else crc end) % 2 * 3988292384))) % 9 as h
          from convs),
        rebuilt as (
          select c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) as path
          from opened c left join convs b on b.conv_id = c.base),
        prefixes as (
          select conv_id, depth, path[1:depth] as node, depth = len(path) as is_end
          from (select *, unnest(range(0, len(path) + 1)) as depth from rebuilt)),
        nodes as (
          select node, depth, min(conv_id) as conv_id, count(*) as n_convs,
            (count(*) - 1) * coalesce(strlen(node[depth].text), 0) as saved,
            sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (is_end), '')) as ends_sha256
          from prefixes group by node, depth),
        children as (
          select node[1:depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by all),
        marked as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (node)),
        sums as (
          select node[1:above] as node, sum((n_children = 0)::int) as n_leaves, sum(saved) as saved_tokens
          from (select *, unnest(range(0, depth + 1)) as above from marked) group by all)
        select m.conv_id, m.depth, p.conv_id as parent_conv_id, m.n_convs, m.n_children, s.n_leaves::bigint as n_leaves,
          s.saved_tokens::bigint as saved_tokens, m.ends_sha256
        from marked m join sums s on s.node = m.node
        left join nodes p on m.depth > 0 and p.node = m.node[1:m.depth - 1]
    """,
    "op13_collocations": r"""
        with pieces as (
          select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece
          from documents),
        split as (
          select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as words from pieces),
        totals as (select lang, sum(len(words))::bigint as n from split group by lang),
        sizes as (select unnest([1, 2, 3, 4]) as size),
        grams as (
          select lang, size, unnest([words[i:i + size - 1] for i in range(1, len(words) - size + 2)]) as phrase
          from split, sizes where len(words) >= size),
        counts as (select lang, size, phrase, count(*) as f from grams group by all having count(*) >= 30),
        candidates as (select lang, size, phrase, f as a from counts where size > 1),
        cuts as (
          select c.lang, c.phrase, c.a, k, x.f as l, y.f as r, (2000000::hugeint * c.a) // (x.f + y.f) as score
          from (select *, unnest(range(1, size)) as k from candidates) c
          join counts x on x.lang = c.lang and x.phrase = c.phrase[1:k]
          join counts y on y.lang = c.lang and y.phrase = c.phrase[k + 1:]),
        best as (
          select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        inside as (
          select lang, phrase[i:j] as phrase, a as longer
          from (select *, unnest(range(1, size + 1)) as i from candidates), (select unnest([2, 3, 4]) as j)
          where j <= size and i < j and j - i + 1 < size),
        kept as (
          select * from best b where not exists (
            select 1 from inside w where w.lang = b.lang and w.phrase = b.phrase and 100::hugeint * w.longer >= 80::hugeint * b.a)),
        ranked as (
          select *, array_to_string(phrase, ' ') as words, row_number() over (
            partition by lang order by score desc, a desc, array_to_string(phrase, ' ')) as rank
          from kept)
        select lang, rank, words as phrase, a, l, r, n, score::bigint as score
        from ranked join totals using (lang) where rank <= 2000
    """,
}
