"""Running an extractor over chunks: resume, status ladder, adaptive re-splitting, roll-up.

Chunks are rows, so calls run in parallel. Equal chunks of equal filings are one item of work. A
round asks for the pending items, appends what is finished to a checkpoint table and makes the
children of truncated or filtered chunks the next round's pending ones. A journal keeps every
answer when it arrives. The driver holds the round counter only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions.text import json_string, sha256, sum_if_all
from foliate.operators.chunks import MIN_CHARS, SPLIT_CHARS, adaptive_limit, resplit
from foliate.sources.journal import Journal

#: What a checkpoint must agree on with a chunk to be its answer.
IDENTITY = ("chunk_text_sha256", "chunk_id", "character_start", "character_end", "prompt_version", "prompt_sha256", "source_content_sha256", "text_content_sha256")
EFFORTS = ("none", "minimal", "low", "medium", "high", "xhigh")
MIN_OUTPUT_TOKENS = 1024
#: What an extractor returns for one prompt.
ANSWER = "outcome string, model string, response_id string, input_tokens long, output_tokens long, raw_response string, claims string, diagnostics string"
#: Outcomes of a call that came back; raised and not_asked, which say why there is no answer, are ask's own.
FINISHED = ("completed", "truncated", "content_filtered")
Extractor = Callable[[str, str], dict]


def check_settings(effort: str | None, max_output_tokens: int) -> None:
    if effort is not None and effort not in EFFORTS:
        raise ValueError(f"effort is one of {', '.join(EFFORTS)}")
    if max_output_tokens < MIN_OUTPUT_TOKENS:
        raise ValueError(f"max_output_tokens is {MIN_OUTPUT_TOKENS} at least")


def response_outcome(status: Column, reason: Column, parsed: Column) -> Column:
    """content_filtered, truncated, not_completed, invalid_output or completed; the first that holds."""
    return (
        F.when(reason == "content_filter", "content_filtered").when(reason == "max_output_tokens", "truncated")
        .when(~status.eqNullSafe(F.lit("completed")), "not_completed").when(parsed.isNull(), "invalid_output").otherwise("completed")
    )


def diagnostics(status: Column, reason: Column, input_tokens: Column, output_tokens: Column, text: Column) -> Column:
    parts = [F.concat(F.lit(f"{n}="), F.coalesce(c.cast("string"), F.lit("unknown"))) for n, c in (("status", status), ("reason", reason), ("input_tokens", input_tokens), ("output_tokens", output_tokens))]
    return F.array_join(F.array(*parts, F.concat(F.lit("output_characters="), F.length(F.coalesce(text, F.lit(""))).cast("string"))), ", ")


def checkpoint_id(df: DataFrame) -> DataFrame:
    """Add chunk_text_sha256 and the 16-digit id of a chunk's checkpoint: a hash of all that
    determines its answer, as JSON with sorted keys (a fixed format)."""
    named = (
        ("chunk_end", "character_end"), ("chunk_id", "chunk_id"), ("chunk_start", "character_start"), ("chunk_text_sha256", "chunk_text_sha256"), ("prompt_sha256", "prompt_sha256"),
        ("prompt_version", "prompt_version"), ("source_content_sha256", "source_content_sha256"), ("text_content_sha256", "text_content_sha256"),
    )
    value = lambda c: F.col(c).cast("string") if c.startswith("character_") else json_string(F.col(c))
    parts = [F.concat(F.lit(f'"{n}": '), value(c)) for n, c in named]
    return df.withColumn("chunk_text_sha256", sha256(F.col("text"))).withColumn("checkpoint_id", F.left(sha256(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))), F.lit(16)))


def split_work(chunks: DataFrame, checkpoints: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Chunks whose checkpoint exists, and those still to be asked for."""
    return chunks.join(checkpoints, list(keys), "left_semi"), chunks.join(checkpoints, list(keys), "left_anti")


def work_items(chunks: DataFrame) -> DataFrame:
    """One row for each identity: that of its chunk with the least chunk_key."""
    rest = [c for c in chunks.columns if c not in IDENTITY and c != "chunk_key"]
    return chunks.groupBy(*IDENTITY).agg(F.min(F.struct("chunk_key", *rest)).alias("_x")).select(*IDENTITY, "_x.*")


def ask(pending: DataFrame, extractor: Extractor, parallelism: int | None = None, prompt: Column | None = None, journal: Journal | None = None) -> DataFrame:
    """Call extractor(chunk_id, prompt) for each row and add its answer; parallelism bounds the calls
    at once; the prompt is the text, unless another expression over pending is given.

    An extractor that raises doesn't fail the task: its row's outcome is raised, with the error in
    diagnostics, and the rows after it in the task aren't asked (not_asked), so all answers so far are
    kept. A journal keeps each answer when it arrives and gives it to a task that is run again.
    """
    names = [c.split()[0] for c in ANSWER.split(", ")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pending.schema.fields) + ", " + ANSWER
    if parallelism:
        pending = pending.repartition(parallelism)

    def answer_to(chunk_id: str, text: str) -> dict:
        key = journal.key(chunk_id, text) if journal else ""
        kept = journal.get(key) if journal else None
        if kept is not None:
            return kept
        got = extractor(chunk_id, text)
        if journal and got.get("outcome") in FINISHED:
            journal.put(key, got)
        return got

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        broken = None
        for batch in batches:
            answers = []
            for i, t in zip(batch.column("chunk_id").to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if broken:
                    answers.append({"outcome": "not_asked", "diagnostics": broken})
                    continue
                try:
                    answers.append(answer_to(i, t))
                except Exception as error:  # the answers before it must not be lost
                    broken = f"{type(error).__name__}: {error}"
                    answers.append({"outcome": "raised", "diagnostics": broken})
            batch = batch.select(batch.schema.names[:-1])
            extra = []
            for n in names:
                values = [a.get(n) for a in answers]
                if n == "claims":
                    values = [None if v is None else v if isinstance(v, str) else json.dumps(v) for v in values]
                extra.append(pa.array(values, pa.int64() if n.endswith("_tokens") else pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *names])

    return pending.withColumn("_prompt", F.col("text") if prompt is None else prompt).mapInArrow(run, schema)


def children_of(parents: DataFrame, split_chars: int = SPLIT_CHARS) -> DataFrame:
    """Children of chunks: cut at split_chars, else, for texts over MIN_CHARS, at half their length."""
    both = resplit(parents, "chunk_key", split_chars, F.when(F.length("text") > MIN_CHARS, adaptive_limit(F.col("text"))))
    return both.withColumn("parent_key", F.col("chunk_key")).withColumn("chunk_key", F.concat_ws("/", "chunk_key", "chunk_id"))


def run_rounds(pending: DataFrame, extractor: Extractor, save: Callable[[DataFrame, int], DataFrame], split_chars: int = SPLIT_CHARS, max_rounds: int = 24, prompt: Column | None = None, journal: Journal | None = None) -> list[DataFrame]:
    """Ask in rounds until nothing is pending; each round's saved answers, first to last.

    save(df, round) writes a round's rows and returns them as read back. A filtered chunk that
    can't be cut is a recorded gap, a truncated one an error row (outcome failed).
    """
    columns = pending.columns
    base = ["chunk_key", "chunk_id", "character_start", "heading_context", "text"]
    rounds: list[DataFrame] = []
    for k in range(max_rounds):
        answered = save(ask(pending, extractor, prompt=prompt, journal=journal), k)
        open_ = answered.where(F.col("outcome").isin("truncated", "content_filtered"))
        children = save(children_of(open_.select(*base), split_chars), 1000 + k)
        cut = children.select(F.col("parent_key").alias("chunk_key")).distinct().withColumn("was_cut", F.lit(True))
        marked = answered.join(cut, "chunk_key", "left").withColumn("was_cut", F.coalesce("was_cut", F.lit(False)))
        rounds.append(marked.withColumn("outcome", F.when((F.col("outcome") == "truncated") & ~F.col("was_cut"), "failed").otherwise(F.col("outcome"))))
        if children.isEmpty():
            return rounds
        carried = [c for c in columns if c not in children.columns]
        pending = children.join(open_.select(F.col("chunk_key").alias("parent_key"), *carried), "parent_key").select(*columns, "parent_key") if carried else children.select(*columns, "parent_key")
    raise RuntimeError("rounds didn't end")


def roll_up(children: DataFrame, parent: str = "parent_key") -> DataFrame:
    """One answer for each parent: raw answers and claims in child order, tokens summed if all are known,
    filtered if any child is, with the direct children that are named in the reason."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk_id", "raw_response", "claims", "status")))
    out = children.groupBy(parent).agg(
        ordered.alias("rows"), sum_if_all(F.col("input_tokens")).alias("input_tokens"), sum_if_all(F.col("output_tokens")).alias("output_tokens"),
        F.when(F.count_distinct("model") == 1, F.first("model", ignorenulls=True)).alias("model"), F.bool_or(F.col("status") == "content_filtered").alias("filtered"),
    )
    gaps = F.transform(F.filter("rows", lambda r: r["status"] == "content_filtered"), lambda r: r["chunk_id"])
    return out.select(
        parent, F.to_json(F.transform("rows", lambda r: r["raw_response"])).alias("raw_response"), F.flatten(F.transform("rows", lambda r: r["claims"])).alias("claims"), "input_tokens", "output_tokens", "model",
        F.when(F.col("filtered"), "content_filtered").otherwise("completed").alias("status"), F.when(F.col("filtered"), F.concat(F.lit("content_filter in "), F.array_join(gaps, ", "))).alias("failure_reason"),
        F.lit(None).cast("string").alias("response_id"),
    )


def united(rounds: list[DataFrame], claims: str) -> DataFrame:
    """One final answer for each chunk of the first round; cut chunks have their children's, rolled up
    from the last round to the first. claims is the type of the parsed claims."""
    fields = ["raw_response", "claims", "input_tokens", "output_tokens", "model", "status", "failure_reason", "response_id"]
    rolled = None
    for k in range(len(rounds) - 1, -1, -1):
        filtered = F.col("outcome") == "content_filtered"
        rows = rounds[k].withColumns({
            "claims": F.coalesce(F.from_json("claims", claims), F.array().cast(claims)), "status": F.when(filtered, "content_filtered").otherwise(F.col("outcome")),
            "failure_reason": F.when(filtered, F.lit("content_filter")).when(F.col("outcome") != "completed", F.col("outcome")),
        })
        place = ["chunk_key", "chunk_id"] + ["parent_key"] * (k > 0)
        final = rows.where("NOT was_cut").select(*place, *fields)
        if rolled is not None:
            final = final.unionByName(rows.where("was_cut").select(*place).join(rolled, "chunk_key").select(*place, *fields))
        rolled = roll_up(final).withColumnRenamed("parent_key", "chunk_key") if k else final
    return rolled


def single_model(responses: DataFrame, key: str) -> DataFrame:
    """The model of each case, null where answers come from none or several."""
    return responses.groupBy(key).agg(F.when(F.count_distinct("model") == 1, F.max("model")).alias("model"))
