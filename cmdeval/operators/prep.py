"""Corpus preparation: alias resolution, chat rendering, token budget, training order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (COMMAND_ALIASES, IM_END, IM_START, INSTRUCTION_ALIASES,
                         ROWS_PER_STEP, SEQ_BUDGET_TOKENS, SYSTEM_PROMPT, TRAIN_MAX_STEPS,
                         TRAIN_SEED)
from ..config import TrainConfig  # noqa: F401  (type of the config argument)
from ..functions.text import _col, strip, tokens
from .ordering import ranked


def _pick(columns: list[str], aliases: tuple[str, ...], what: str) -> str:
    for name in aliases:
        if name in columns:
            return name
    raise ValueError(f"no {what} column: expected one of {', '.join(aliases)}; got {', '.join(columns)}")


def resolve_pairs(df: DataFrame, null_as_text: bool = False, id_col: str = "pair_id") -> DataFrame:
    """(pair_id, instruction, command) from any accepted column names.

    The alias is chosen once, at plan time, against ``df.columns``. Text is
    stripped of Unicode whitespace. Null pairs are dropped unless
    ``null_as_text`` asks for the literal ``"None"`` a Python ``str()`` gives.
    """
    src_i = _pick(df.columns, INSTRUCTION_ALIASES, "instruction")
    src_c = _pick(df.columns, COMMAND_ALIASES, "command")
    inst, cmd = F.col(src_i).cast("string"), F.col(src_c).cast("string")
    if null_as_text:
        inst, cmd = F.coalesce(inst, F.lit("None")), F.coalesce(cmd, F.lit("None"))
    # Without an id, the pair's own content names it: the order of a run doesn't hang on file layout.
    own = F.xxhash64(inst, cmd)
    pid = F.coalesce(F.col(id_col).cast("bigint"), own) if id_col in df.columns else own
    out = df.select(pid.alias("pair_id"), strip(inst).alias("instruction"), strip(cmd).alias("command"))
    if not null_as_text:
        out = out.where(F.col("instruction").isNotNull() & F.col("command").isNotNull())
    return out


def chat_block(role: Column | str, content: Column | str) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.concat(F.lit(IM_START), role, F.lit("\n"), _col(content), F.lit(IM_END + "\n"))


def render_training(df: DataFrame, system: str = SYSTEM_PROMPT, instruction: str = "instruction",
                    command: str = "command", out: str = "text") -> DataFrame:
    """System + user + assistant blocks, no generation prompt (one training example per row)."""
    return df.withColumn(out, F.concat(chat_block("system", F.lit(system)),
                                       chat_block("user", instruction),
                                       chat_block("assistant", command)))


def render_prompt(df: DataFrame, system: str | Column = SYSTEM_PROMPT, user: str = "instruction",
                  out: str = "prompt") -> DataFrame:
    """Inference prompt: optional system and user blocks, then the assistant header."""
    sys_col = F.lit(system) if isinstance(system, str) else system
    usr = _col(user)
    sys_part = F.when(F.coalesce(sys_col, F.lit("")) != "", chat_block("system", sys_col)).otherwise(F.lit(""))
    usr_part = F.when(F.coalesce(usr, F.lit("")) != "", chat_block("user", usr)).otherwise(F.lit(""))
    return df.withColumn(out, F.concat(sys_part, usr_part, F.lit(IM_START + "assistant\n")))


def render_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", content: str = "text", chunk_turns: int = 256) -> DataFrame:
    """Whole conversations rendered in turn order: (conv_id, n_turns, text).

    Two-level ordered concatenation: turns are first joined inside chunks of
    ``chunk_turns`` consecutive turns, then chunks inside the conversation. The
    second level gathers one conversation's text in one row, as the result has
    it; only the sort of its turns is spread.
    """
    blocks = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        (F.col(turn) / F.lit(chunk_turns)).cast("bigint").alias("chunk"),
        chat_block(F.col(role), strip(content)).alias("block"))
    chunks = (blocks.groupBy("conv_id", "chunk")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "block"))),
                                            lambda s: s["block"]), "").alias("part")))
    return (chunks.groupBy("conv_id")
            .agg(F.sum("n").alias("n_turns"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "part"))),
                                          lambda s: s["part"]), "").alias("text")))


def truncate_tokens(df: DataFrame, col: str = "text", budget: int = SEQ_BUDGET_TOKENS,
                    prefix: str = "") -> DataFrame:
    """Token count, the kept head of the token list and an over-budget flag."""
    tok = f"{prefix}tokens"
    return (df.withColumn(tok, tokens(col))
            .withColumn(f"{prefix}n_tokens", F.size(tok).cast("bigint"))
            .withColumn(f"{prefix}kept_tokens", F.slice(tok, 1, budget))
            .withColumn(f"{prefix}over_budget", F.size(tok) > F.lit(budget)))


def training_plan(pairs: DataFrame, seed: int = TRAIN_SEED, rows_per_step: int = ROWS_PER_STEP,
                  max_steps: int | None = TRAIN_MAX_STEPS, id_col: str = "pair_id",
                  config: "TrainConfig | None" = None, resume_step: int = 0) -> DataFrame:
    """Seeded order and step assignment of the rows a run consumes.

    A ``config`` (``cmdeval.config.TrainConfig``) overrides the three numbers.

    The order key is ``md5(seed ':' pair_id)``; ties go by id. With ``max_steps`` only ``max_steps *
    rows_per_step`` rows are used, so the sort is a bounded top-k (TakeOrderedAndProject) and the rank
    runs on that bounded set. ``max_steps=None`` ranks all rows (one epoch) by ranges, see ``ordering.ranked``.
    ``resume_step`` leaves out the rows of the steps that a stopped run has done; ranks and steps stay the same.
    """
    if config is not None:
        seed, rows_per_step, max_steps = config.seed, config.rows_per_step, config.max_steps
    if resume_step < 0 or rows_per_step < 1:
        raise ValueError("resume_step must not be negative and rows_per_step not below 1")
    keyed = pairs.withColumn("order_key", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))))
    if max_steps is None:
        order = ranked(keyed, [F.col("order_key"), F.col(id_col)])
    else:
        head = keyed.orderBy("order_key", id_col).limit(max_steps * rows_per_step)
        order = head.withColumn("rank", F.row_number().over(Window.orderBy("order_key", id_col)).cast("bigint"))
    order = order.withColumn("step", (F.floor((F.col("rank") - 1) / rows_per_step) + 1).cast("bigint"))
    return order.where(F.col("step") > resume_step) if resume_step else order


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """A user's batched column map (dict of column lists in, dict out), run per Arrow batch.

    ``fn`` receives ``{column: list}`` for one batch and returns the output
    columns as ``{column: list}`` of the same length; ``schema`` declares
    them. Built-in column functions are faster: use this only for logic they
    cannot express.
    """
    import pyarrow as pa

    from ..session import ensure_package_on_workers

    ensure_package_on_workers(df.sparkSession)

    def per_partition(batches):
        for batch in batches:
            out = fn(batch.to_pydict())
            yield pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(per_partition, schema)
