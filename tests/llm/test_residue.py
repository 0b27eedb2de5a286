"""Residue: marks in running text, and sentences that explain them."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from corpusloom.llm import residue as R


@pytest.fixture(scope="module")
def known():
    exemplars = R.Exemplars()
    exemplars.weigh(1000, {})
    return exemplars


def labels(known, text):
    return {known.judge(w)[0] for w in R.windows(text)} - {""}


@pytest.mark.parametrize(
    "text",
    [
        "Deploy the service to {{x}} with the standard rollout pipeline",
        "Run the export for {{x}} every Monday",
        "Speichere <größe der datei> vor dem nächsten Schritt in der Tabelle",
        "Enter your contract description in this field",
        "Replace this text with your own branch instructions.",
        "Short summary of the fixture skill (replace me)",
    ],
)
def test_unfilled_text_in_prose_is_residue(known, text):
    assert "residue" in labels(known, text)


@pytest.mark.parametrize(
    "text",
    [
        "Replace {{name}} with the value from the sheet",
        "Fills {{x}} style templates for a frame from tabular data",
        "Every {{x}} mark in the template is filled by the loader from the matching column",
        "Deploy `{{x}}` with the standard rollout pipeline",
        "Todo el equipo revisa la tabla antes de la entrega",
        "Put the call into __init__ and set ${HOME} first",
    ],
)
def test_explained_and_quoted_marks_are_content(known, text):
    assert "residue" not in labels(known, text)


@pytest.mark.parametrize(
    "mark",
    [
        "{{x}}", "{{{x}}}", "{% x %}", "${x}", "#{x}", "<% x %>", "<<x>>", "@@x@@", "%(name)s", "%NAME%", "%ſKILL%", "__NAME__", "__ſKILL__",
        "<título del recurso>", "<größe der datei>", "<step2 name>", "<½ x>", "<your name>", "<add>", "[insérer le nom du projet]", "[insert x]", "[İnsert x]",
        "[one sentence on it]", "[x goes here]", "[text aquí]", "[todo]", "[insert `a](b` name]",
    ],
)
def test_prefilter_finds_every_mark(mark):
    text = f"Run it with {mark} and wait."
    assert any(R.MARK in w for w in R.windows(text))
    assert pc.match_substring_regex(pa.array([text]), R.MARKS_RE2)[0].as_py()


@pytest.mark.parametrize("lead", ["FIXME:", "todo:", "TBD", "fıxme:"])
def test_prefilter_finds_a_lead_word_after_a_sentence(known, lead):
    text = f"It runs. {lead} write the rest of it"
    assert "residue" in labels(known, text)
    assert pc.match_substring_regex(pa.array([text]), R.MARKS_RE2)[0].as_py()


def test_texts_with_only_a_foreign_mark_are_judged(known):
    class Shared:
        value = known

    texts = ["Speichere <größe der datei> vor dem Lauf", "Abre <título del recurso> con la tabla", "Run it. FIXME: write the rest", "Sort the table"]
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "c", "d"]), pa.array(texts)], ["_key", "body"])
    (found,) = R._residue(Shared, 1)(iter([batch]))
    assert found.column(0).to_pylist() == ["a", "b", "c"]
