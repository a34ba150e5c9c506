"""Run configuration (the data-relevant part of a fine-tuning run)."""

from __future__ import annotations

from dataclasses import dataclass

from .constants import (SEQ_BUDGET_TOKENS, TRAIN_BATCH_SIZE, TRAIN_GRAD_ACCUM, TRAIN_MAX_STEPS,
                        TRAIN_SEED)


@dataclass(frozen=True)
class TrainConfig:
    """Parameters that decide which rows a run reads and how they are grouped.

    Model, optimizer and export settings belong to the trainer, not here.
    """

    max_seq_length: int = SEQ_BUDGET_TOKENS
    batch_size: int = TRAIN_BATCH_SIZE
    grad_accum_steps: int = TRAIN_GRAD_ACCUM
    max_steps: int = TRAIN_MAX_STEPS
    seed: int = TRAIN_SEED
    logging_steps: int = 10

    @property
    def rows_per_step(self) -> int:
        return self.batch_size * self.grad_accum_steps

    @property
    def rows_used(self) -> int:
        return self.max_steps * self.rows_per_step
