import pytest
from pyspark.sql import functions as F

from tunewright.operators import infer, templates, tokens
from tunewright.operators import prompt as pr
from tunewright.plans import data_prep
from tunewright.specs import FULL_TEMPLATE, INPUT_TEMPLATE, DataSpec, PromptSpec


@pytest.fixture()
def simple(spark):
    return spark.createDataFrame(
        [("Revenue rose 10%.", 2), ("Net loss of $5M.", 0)], "sentence string, label long"
    ).coalesce(1)


def texts(df, column="prompt"):
    return [r[column] for r in df.collect()]


def test_substitution(simple):
    out = pr.format_prompts(simple, PromptSpec("Text: {sentence} | Label: {label}", output_column="prompt"))
    assert texts(out) == [
        "Text: Revenue rose 10%. | Label: 2",
        "Text: Net loss of $5M. | Label: 0",
    ]


def test_aliases_and_originals(simple):
    spec = PromptSpec(
        "{text} -> {sentiment} ({sentence})", {"text": "sentence", "sentiment": "label"}, None, "prompt"
    )
    assert texts(pr.format_prompts(simple, spec))[0] == "Revenue rose 10%. -> 2 (Revenue rose 10%.)"


def test_missing_variable(simple):
    with pytest.raises(KeyError, match="nonexistent_column"):
        pr.format_prompts(simple, PromptSpec("{nonexistent_column}"))
    with pytest.raises(KeyError, match="nope"):
        pr.format_prompts(simple, PromptSpec("{a}", {"a": "nope"}))


def test_output_column_and_input_unchanged(simple):
    out = pr.format_prompts(simple, PromptSpec("{sentence}", output_column="my_col"))
    assert "my_col" in out.columns and simple.columns == ["sentence", "label"]


def test_system_prompt(simple):
    spec = PromptSpec("Text: {sentence}", {}, " You are helpful.\n", "prompt")
    assert texts(pr.format_prompts(simple, spec))[0] == "You are helpful.\n\nText: Revenue rose 10%."


def test_values_look_like_python(spark):
    df = spark.createDataFrame([(True, None, 3, 2.5)], "b boolean, s string, i int, x double")
    spec = PromptSpec("{b} {s} {i:d} {x:.1f} {x} {{}}", output_column="prompt")
    assert texts(pr.format_prompts(df, spec)) == ["True None 3 2.5 2.5 {}"]
    with pytest.raises(ValueError, match="not supported"):
        pr.format_prompts(df, PromptSpec("{x:>10}"))


def test_plan_has_no_python(simple):
    out = pr.format_prompts(simple, PromptSpec("{sentence}{label}"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_strip_prompt(spark):
    df = spark.createDataFrame(
        [("Hello World", "Hello "), ("No match here", "XYZ")], "o string, p string"
    ).coalesce(1)
    out = df.select(pr.strip_prompt(F.col("o"), F.col("p")).alias("prompt"))
    assert texts(out) == ["World", "No match here"]


def test_templates(spark):
    names = ["HuggingFaceTB/SmolLM2-135M", "unknown/xyz-123", "", "x/SmolLM2-360M", "SmolLM-1", "my-GPT2"]
    df = spark.createDataFrame([(n,) for n in names], "model_name string").coalesce(1)
    out = templates.resolve(df).collect()
    assert [r.template_key for r in out] == [
        "HuggingFaceTB/SmolLM2-135M", None, None, "HuggingFaceTB/SmolLM2-360M", "SmolLM2", "gpt2",
    ]
    assert out[0].formatting_template == FULL_TEMPLATE
    assert out[0].eval_input_template == INPUT_TEMPLATE and out[1].eval_input_template is None
    for name, row in zip(names, out):
        assert (templates.for_model(name) is None) == (row.template_key is None)
    assert templates.for_model(None) is None


def test_model_template_replaces_the_configured_one():
    spec = DataSpec(prompt=PromptSpec("Custom {x}"))
    assert data_prep.prompt_spec(spec).template == "Custom {x}"
    named = DataSpec(prompt=PromptSpec("Custom {x}"), model_name="sshleifer/tiny-gpt2")
    assert data_prep.prompt_spec(named).template == FULL_TEMPLATE


def test_tokenize(spark):
    df = spark.createDataFrame([(1, " a b\nc d "), (2, None)], "id int, t string").coalesce(1)
    out = tokens.tokenize(df, "t", 3, keep=("id",)).collect()
    assert (out[0].tokens, out[0].n_tokens, out[0].was_truncated) == (["a", "b", "c"], 3, True)
    assert (out[1].tokens, out[1].n_tokens, out[1].was_truncated) == ([], 0, False)
    assert tokens.tokenize(df, "t", 3).columns == ["tokens", "n_tokens", "was_truncated"]


def test_tokenizer_factory(spark):
    def factory():
        return lambda texts: [[ord(c) for c in t] for t in texts]

    df = spark.createDataFrame([("abc",)], "t string")
    assert tokens.tokenize(df, "t", 2, factory).collect()[0].tokens == [97, 98]


def test_predict_batches_and_skips_nulls(spark):
    def factory():
        def model(prompts, limit):
            assert 0 < len(prompts) <= 3 and None not in prompts
            return [f"{p}|{len(prompts)}|{limit}" for p in prompts]

        return model

    df = spark.createDataFrame([(i, None if i == 2 else f"p{i}") for i in range(6)], "id int, p string")
    out = infer.predict(df.coalesce(1), "p", factory, 3, 7).orderBy("id").collect()
    assert [r.raw_output for r in out] == ["p0|3|7", "p1|3|7", None, "p3|3|7", "p4|2|7", "p5|2|7"]


def test_predict_needs_one_answer_per_prompt(spark):
    df = spark.createDataFrame([("a",), ("b",)], "p string").coalesce(1)
    with pytest.raises(Exception, match="zip"):
        infer.predict(df, "p", lambda: (lambda prompts, limit: ["one"])).collect()


def test_qualitative(spark):
    df = spark.createDataFrame([("What is a bond?",), ("Define equity.",)], "prompt string").coalesce(1)
    out = infer.qualitative(df, lambda: (lambda ps, n: [p + " Generated answer." for p in ps])).collect()
    assert [tuple(r) for r in out] == [
        ("What is a bond?", "Generated answer."), ("Define equity.", "Generated answer."),
    ]


def test_ask(spark):
    df = spark.createDataFrame(
        [("What?", None), ("What?", "ctx"), (None, None), ("  ", "ctx")],
        "question string, context string",
    ).coalesce(1)
    out = infer.ask(df).collect()
    assert [r.prompt for r in out] == ["What?", "Context: ctx\n\nQuestion: What?", None, None]
    assert [r.error is None for r in out] == [True, True, False, False]
    assert infer.ask(df, template="Q: {question}").collect()[0].prompt == "Q: What?"
