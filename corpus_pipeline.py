"""The corpus pipeline: STAGES in order, and `run`, which applies them to `documents`. The stages call the operators of
trailmark.llm; see trailmark/llm/stages.py for what each keeps and how odd rows fare."""

from __future__ import annotations

from trailmark.llm.stages import (  # noqa: F401
    ORACLE_SQL,
    STAGES,
    drop_copies,
    drop_near_copies,
    drop_toxic,
    mix_sources,
    run,
    tokenise,
)
