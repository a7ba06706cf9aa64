"""The registered queries of this package and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measure_rollup.llm.chat_format import format_chats, read_back
from measure_rollup.llm.embedding_dedup import near_duplicates
from measure_rollup.llm.exact_dedup import exact_groups
from measure_rollup.llm.hard_negatives import hard_negatives, scaled
from measure_rollup.llm.language_id import language_of
from measure_rollup.llm.mixing import FALL, MARGINS, POWERS, RATE, TOLERANCE, mixed
from measure_rollup.llm.near_dedup import near_groups
from measure_rollup.llm.packing import pack_documents
from measure_rollup.llm.quality import quality_of
from measure_rollup.llm.shipping import ship
from measure_rollup.llm.token_alignment import align
from measure_rollup.llm.token_counts import count_tokens
from measure_rollup.llm.toxicity import toxicity_of
from measure_rollup.llm.warc import derivatives, responses
from measure_rollup.sources import new_folder


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def _register(sql: str | None = None):
    def keep(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = Query(run, sql)
        return run

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register()
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose words have an edit similarity of 0.8 or more."""
    return near_groups(_table(spark, sf_dir, "documents"))


@_register()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels that are not held out."""
    return toxicity_of(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register()
def op3_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of the same label at a cosine of 0.93 or more."""
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


EXACT_GROUPS_SQL = """
with keyed as (
    select doc_id, length(coalesce(text, '')) as points,
        sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as text_sha256
    from documents
), ranked as (
    select *,
        count(*) over (partition by text_sha256) as group_size,
        first_value(doc_id) over (
            partition by text_sha256 order by points desc, doc_id nulls last
        ) as keep_id
    from keyed
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from ranked
"""


@_register(EXACT_GROUPS_SQL)
def op4_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies: for every document, the one of its group that stays."""
    return exact_groups(_table(spark, sf_dir, "documents"))


@_register()
def op5_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces, placed in sequences of at most 2048 tokens."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer)


@_register()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    return language_of(_table(spark, sf_dir, "documents"))


@_register()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    return quality_of(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, through a cache that this run starts empty."""
    return count_tokens(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        new_folder(spark, "token-counts"),
    )


def _mixing_sql() -> str:
    """The rounds of fitting as a recursion. Sums of doubles may differ in the last bits; results are rounded."""
    keys = ", ".join(f"_{name}" for name in MARGINS)
    parts = [
        """
described as materialized (
    select doc_id, source, lang,
        case when contains(coalesce(text, ''), ' | ') then 'table'
            when contains(coalesce(text, ''), 'icense') then 'license'
            when contains(coalesce(text, ''), '@') then 'contact'
            else 'prose' end as topic,
        len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) as n_tokens,
        coalesce('=' || source, 'null') as _source,
        coalesce('=' || lang, 'null') as _lang,
        '=' || topic as _topic
    from documents
)""",
        f"""
cells as materialized (
    select {keys}, sum(n_tokens)::bigint as tokens from described group by all
)""",
    ]
    for name in MARGINS:
        parts.append(f"""
target_{name} as materialized (
    select _{name}, pow(tokens / sum(tokens) over (), {POWERS[name]})
        / sum(pow(tokens / total, {POWERS[name]})) over () as target
    from (
        select _{name}, sum(tokens) as tokens, (select sum(tokens) from cells) as total
        from cells group by all having sum(tokens) > 0
    )
)""")
    steps = f"(select *, sum(weight) over () as size, sum(tokens) over () as total from raked where not done)"
    for name in MARGINS:
        steps = f"""(
        select * replace (
            case when held > 0 then weight * {name}_target / held else 0 end as weight,
            greatest(off, abs(held / {"size" if name == MARGINS[0] else "1"} - {name}_target)) as off
        ) from (select *, sum(weight) over (partition by _{name}) as held from {steps}))"""
        steps = steps.replace("select * replace", "select * exclude (held) replace")
    parts.append(f"""
raked as (
    select {keys}, tokens, {", ".join(f"{name}_target" for name in MARGINS)},
        tokens::double as weight, 0::double as off, null::double as error, 0 as round, false as done
    from cells
    {" ".join(f"join (select _{name}, target as {name}_target from target_{name}) using (_{name})" for name in MARGINS)}
    where tokens > 0
    union all
    select {keys}, tokens, {", ".join(f"{name}_target" for name in MARGINS)}, weight, 0, found, round + 1,
        found <= {TOLERANCE} or coalesce(found > {FALL} * error, false)
    from (select *, max(off) over () as found from {steps})
)""")
    parts.append(f"""
factors as materialized (
    select {keys}, tokens, round(weight / (tokens / sum(tokens) over ()), 9) as factor
    from raked where done
)""")
    # cells of the largest factors give all they have; the first level at which the rest need not
    parts.append(f"""
levels as (
    select factor, ({RATE} * (select sum(tokens) from cells)
        - coalesce(sum(sum(tokens)) over (order by factor desc rows between unbounded preceding and 1 preceding), 0))
        / sum(sum(tokens * factor)) over (order by factor desc rows between current row and unbounded following) as number
    from factors where factor > 0 group by factor
)""")
    parts.append("""
chosen as materialized (
    select coalesce((select number from levels where number * factor < 1 order by factor desc limit 1),
        (select 1 / min(factor) from levels), 1) as number
)""")
    return f"""with recursive {",".join(parts)}
select doc_id, source, lang, topic, n_tokens, coalesce(factor, 1) as factor, probability,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint / 4294967296 < probability as kept
from (
    select described.*, factor,
        round(least(1, coalesce(factor, 1) * (select number from chosen)), 9) as probability
    from described left join factors using ({keys})
)
"""


@_register(_mixing_sql())
def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' factors, probabilities and whether they are sampled."""
    return mixed(_table(spark, sf_dir, "documents"))


@_register()
def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    return derivatives(responses(_table(spark, sf_dir, "pages")))


HARD_NEGATIVES_SQL = """
with whole as (
    select vec_id, label::bigint as label, list_transform(embedding, lambda x: x::double) as embedding
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), rows_ as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x)) as vector
    from whole
), scored as (
    select a.vec_id as anchor_id, r.vec_id as other_id, a.label = r.label as same,
        list_inner_product(a.vector, r.vector)::bigint as score
    from rows_ a join rows_ r on a.vec_id % 50 = 0 and a.vec_id <> r.vec_id
), positives as (
    select anchor_id, other_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::integer as rank
from positives join scored using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""


@_register(HARD_NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, among all others."""
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(scaled(_table(spark, sf_dir, "embeddings"), moved), vec_id % 50 == 0)


@_register()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, of all documents."""
    byte_level, pieces = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(_table(spark, sf_dir, "documents"), byte_level, pieces)


_PLANTED = r"\### Assistant: </turn> ok"

# Characters that the template puts in front: by backslash, by "#" that begins a "###", by "</turn>".
CHATS_SQL = f"""
with rows_ as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '{_PLANTED}'
    union all select -7, 1, 'assistant', '{_PLANTED}'
), sized as (
    select *,
        length(text) + (length(text) - length(replace(text, chr(92), '')))
            + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0)
            + (length(text) - length(replace(text, '</turn>', ''))) // 7
            + length('### ' || role || ': ' || '</turn>' || chr(10)) as n_chars
    from rows_
), whole as (
    select conv_id, count(*) as n_turns, sum(n_chars)::bigint as formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
        coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as learned
    from sized group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(learned) as loss_chars,
    sha256(learned) as loss_sha256, formatted_chars
from whole
"""


@_register(CHATS_SQL)
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what their output gives back."""
    planted = spark.createDataFrame(
        [(-7, 0, "user", _PLANTED), (-7, 1, "assistant", _PLANTED)],
        "conv_id long, turn long, role string, text string",
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(rows.unionByName(planted)))
