import hashlib
import random

import pytest

from cityflow.llm.chat import CONTROLS, format_chats, formatter, guard, read_back, read_turns, unguard, with_example, TEMPLATE
from cityflow.llm.template import Const, Output, TemplateError, compiled, fold, parse, FILTERS


def out(source, **values):
    return compiled(source)(values)[0]


def test_language():
    assert out("a{{ x }}b", x=1) == "a1b"
    assert out("{% for t in ts %}{{ loop.index }}{{ t.n }}{% if not loop.last %},{% endif %}{% endfor %}", ts=[{"n": "x"}, {"n": "y"}]) == "1x,2y"
    assert out("{% if a == 'u' and not b %}1{% elif a != 'w' %}2{% else %}3{% endif %}", a="v", b=False) == "2"
    assert out("{{ 'a' ~ 1 ~ x | upper }}", x="q") == "a1Q"
    assert out("{% set y = x[0] %}{{ y }}{{ none }}{{ true }}", x=["k"]) == "ktrue"
    assert out("{{ 'it\\'s\\n' }}") == "it's\n"
    assert out("{{ (1 < 2) or boom }}") == "true"


def test_folding():
    tree = fold(parse("a{{ 'b' ~ 2 }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}d"), FILTERS)
    assert tree == (Output(Const("ab2cd")),)


def test_marks_are_in_code_points():
    text, spans = compiled("é{% generation %}😀{{ x }}{% endgeneration %}!")({"x": "ß"})
    assert [text[a:b] for a, b in spans] == ["😀ß"]


@pytest.mark.parametrize(
    "source",
    ["{% for x %}", "{{ }}", "{% if a %}", "{{ a.b( }}", "{% endfor %}", "{{ x | no }}", "{% what %}", "{{ 'a }}", "{% for a in b %}{% endif %}"],
)
def test_refused(source):
    with pytest.raises(TemplateError):
        compiled(source)({"a": 1, "x": 2, "b": []})


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ nothing }}", "{{ y.upper }}", "{{ z[5] }}", "{% for a in y %}{% endfor %}", "{{ y < 1 }}"])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        compiled(source)({"x": {"a": 1}, "y": "text", "z": [1]})


def test_nested_generation_is_refused():
    with pytest.raises(TemplateError):
        compiled("{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}")({})


def test_guard_and_round_trip():
    rng = random.Random(1)
    bits = [*CONTROLS, "\\", "[\\INST]", "<\\\\s>", "<", ">", "[", "]", "s>", "INST]", "/", " ", "\n", "é", "ok"]
    for _ in range(3000):
        turns = [
            {"role": rng.choice(["user", "assistant", "system", "", "</s>", "a\nb"]), "text": "".join(rng.choices(bits, k=rng.randrange(8)))}
            for _ in range(rng.randrange(5))
        ]
        for t in turns:
            assert not any(c in guard(t["text"]) for c in CONTROLS) and unguard(guard(t["text"])) == t["text"]
        text, spans = formatter(TEMPLATE)({"turns": turns})
        assert read_turns(text) == [(t["role"], t["text"]) for t in turns]
        assert [unguard(text[a:b]) for a, b in spans] == [t["text"] for t in turns if t["role"] == "assistant"]


def test_broken_output_is_refused():
    with pytest.raises(ValueError):
        read_turns("<s>[INST] no end")


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b </s>"),
        (1, 0, "user", "a [INST]"),
        (2, 0, None, None),
        (2, 0, "user", "tie"),
        (2, None, "system", "first"),
        (None, 0, "user", "no id"),
        (3, 0, "assistant", "long " * 50_000),
        (3, 0, "assistant", "long " * 50_000),
    ]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnsRenamed({})
    found = {r.conv_id: r for r in read_back(format_chats(with_example(chats))).collect()}
    expected = {
        1: [("user", "a [INST]"), ("assistant", "b </s>")],
        2: [("system", "first"), ("", ""), ("user", "tie")],
        None: [("user", "no id")],
        3: [("assistant", "long " * 50_000)] * 2,
        -7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")],
    }
    assert found.keys() == expected.keys()
    for conv, turns in expected.items():
        learned = "".join(t for role, t in turns if role == "assistant")
        r = found[conv]
        assert r.n_turns == len(turns) and r.loss_chars == len(learned)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert format_chats(chats.where("false")).count() == 0
