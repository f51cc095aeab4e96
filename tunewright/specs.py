"""Parameters of the operators, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

# The refusal text, system prompt, scope phrases and prompt templates must be equal
# to those users already have in their data.
REFUSAL_MESSAGE = "I don't have enough information to answer this confidently."

DEFAULT_SYSTEM_PROMPT = """You are a financial analyst assistant.
Answer only questions related to finance, accounting, and investment.

If a question is outside your knowledge or outside the finance domain,
you MUST respond with: "I don't have enough information to answer this confidently."

Never fabricate figures, dates, or financial data."""

ANCHOR_PHRASES = (
    "stock valuation and equity analysis",
    "financial statements and accounting",
    "investment portfolio management",
    "corporate finance and capital structure",
    "banking and interest rates",
    "financial ratios and metrics",
)

SENTIMENT_TEMPLATE = (
    "### Instruction:\n"
    "Classify the sentiment of the following financial text "
    "as positive, negative, or neutral.\n\n"
    "### Input:\n{sentence}\n\n### Response:\n{label}"
)
FULL_TEMPLATE = "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{output}"
INPUT_TEMPLATE = "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n"


@dataclass(frozen=True)
class SampleSpec:
    n: int | None = None
    strategy: str = "random"
    seed: int = 42
    stratify_column: str | None = None
    text_columns: tuple[str, ...] | None = None
    vector_column: str | None = None
    min_chars: int = 20
    max_chars: int = 4000
    dedup_threshold: float = 0.95
    order_by: tuple[str, ...] | None = None
    # for strategy "curated"
    output_column: str = "output"
    instruction_column: str = "instruction"
    score_column: str | None = None
    min_score: float = 0.0


@dataclass(frozen=True)
class CleanSpec:
    drop_missing: bool = True
    drop_duplicates: bool = True
    strip: bool = True
    lower: bool = False
    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class SplitSpec:
    train: float = 0.8
    val: float = 0.1
    test: float = 0.1
    seed: int = 42
    stratify_column: str | None = None


@dataclass(frozen=True)
class PromptSpec:
    template: str = SENTIMENT_TEMPLATE
    aliases: dict[str, str] = field(default_factory=dict)
    system_prompt: str | None = None
    output_column: str = "formatted_text"


@dataclass(frozen=True)
class GuardSpec:
    confidence_threshold: float = 0.45
    scope_threshold: float = 0.40
    anchors: tuple[str, ...] = ANCHOR_PHRASES
    check_before: bool = True


@dataclass(frozen=True)
class EvalSpec:
    metrics: tuple[str, ...] = ("rouge", "bertscore", "semantic_similarity")
    max_new_tokens: int = 256
    input_template: str = INPUT_TEMPLATE
    reference_column: str = "output"
    aliases: dict[str, str] = field(default_factory=dict)
    system_prompt: str | None = None
    answerable_column: str | None = None
    guard: GuardSpec | None = None
    batch_size: int = 8


@dataclass(frozen=True)
class DataSpec:
    path: str = ""
    fmt: str = "parquet"
    split: str | None = None
    split_column: str = "split"
    key: tuple[str, ...] = ("id",)
    sample: SampleSpec = SampleSpec()
    clean: CleanSpec = CleanSpec()
    split_spec: SplitSpec = SplitSpec()
    prompt: PromptSpec = PromptSpec()
    sample_after_clean: bool = False
    model_name: str | None = None
    use_model_template: bool = True
