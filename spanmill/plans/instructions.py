"""Entry 2: subset -> prompts -> replies -> instruction rows; plus the validation split.

subset -> G1 prompts -> [model outside] -> G2 attach replies -> F9/F8 filters ->
G3 blocks -> G4 cap.  Validation: V1 parse -> V2 judge prompts -> V3 verdicts -> V4 split.
All steps are row-local except the reply/verdict joins on ``ord``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import prompts as G
from ..options import DEFAULT_JUDGE_TEMPLATE, GenerateOptions
from ..session import cut_lineage

INSTRUCTION_COLUMNS = ["ord", "block", "instruction", "response", "category"]


@dataclass
class InstructionsResult:
    prompts: DataFrame
    rows: DataFrame
    rejects: DataFrame


def build_instructions(subset_rows: DataFrame, replies: DataFrame,
                       opts: GenerateOptions = GenerateOptions(),
                       materialize: bool = False) -> InstructionsResult:
    prompts = G.render_prompts(subset_rows, opts.template)
    replied, no_reply = G.attach_replies(subset_rows, replies)
    rows, bad = G.parse_replies(replied, opts)
    rows = G.cap_rows(rows, opts.target_count)
    if materialize:
        rows = cut_lineage(rows)
    return InstructionsResult(prompts, rows, no_reply.unionByName(bad))


@dataclass
class ValidationResult:
    judge_prompts: DataFrame
    valid: DataFrame
    invalid: DataFrame
    rejects: DataFrame


def validate(instructions: DataFrame, verdicts: DataFrame,
             template: str = DEFAULT_JUDGE_TEMPLATE) -> ValidationResult:
    carried = [c for c in INSTRUCTION_COLUMNS if c not in ("ord", "block")]
    parsed, bad = G.parse_instructions(instructions, carried)
    judge = G.judge_prompts(parsed, template)
    judged, missing = G.attach_verdicts(parsed.select(*INSTRUCTION_COLUMNS), verdicts)
    valid, invalid = G.split_by_verdict(judged, INSTRUCTION_COLUMNS)
    return ValidationResult(judge, valid, invalid, bad.unionByName(missing))
