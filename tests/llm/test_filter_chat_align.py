"""Operators 11 to 13 against brute force, and their awkward cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import op11_filter_audit as op11
from factloom.llm import op12_chat_format as op12
from factloom.llm import op13_alignment as op13
from factloom.llm.chat_template import Output, Template, TemplateError
from tests.llm.helpers import awkward, documents, prose

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


# 11: filters
def failed(rows):
    """The letters that each (doc_id, text) fails."""
    least = {}
    for i, t in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in t) > 3 * len(t))
        f += "D" * any(c in "#$%&*|" for c in t) + "E" * (i is not None and least.get(t, i) < i)
        out.append(f)
    return out


def audited(parts, masks, good, toxic):
    found = {}
    for part in set(parts):
        own = [(m, g, x) for p, m, g, x in zip(parts, masks, good, toxic) if p == part]
        removed = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order):
                left = [r for r in own if not set(order[:step]) & set(r[0])]
                out = [r for r in left if f in r[0]]
                removed[f] += len(out)
                fails = sum(f in r[0] for r in own)
                found[part, order, step + 1] = [len(left) - len(out), len(out), fails - len(out), sum(r[0] == f for r in own), sum(r[1] for r in out), sum(r[2] for r in out)]
        for (p, order, step), row in found.items():
            if p == part:
                row.append(removed[order[step - 1]])
    return found


def test_op11_against_all_orders(spark):
    rows = awkward() + [(i, t) for i, t in zip(range(100, 130), [prose(i, 230).replace("the", "THE") if i % 3 else prose(i, 20) * 12 + "#" for i in range(15)] * 2)] + [(None, "a"), (None, None), (40, "a"), (41, "a"), (41, "a")]
    langs = [["en", None, "fr", ""][i % 4] for i in range(len(rows))]
    docs = spark.createDataFrame([(i, t, g, "x", 1) for (i, t), g in zip(rows, langs)], "doc_id long, text string, lang string, key string, n long").repartition(3)
    labels = [(i, i % 2, int(i % 3 == 0)) for i in {r[0] for r in rows if r[0] is not None} if i % 5] + [(1, 0, 1), (None, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id long, quality long, toxic long")
    marks = {i: (max(q for j, q, _ in labels if j == i), max(x for j, _, x in labels if j == i)) for i in {x[0] for x in labels} if i is not None}
    want = audited([g or "" for g in langs], failed(rows), [marks.get(i, (0, 0))[0] for i, _ in rows], [marks.get(i, (0, 0))[1] for i, _ in rows])
    got = {(r[0], r[1], r[2]): list(r)[3:] for r in op11.filter_audit(docs, lab).collect()}
    assert got == want


def test_op11_empty_and_long(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert op11.filter_audit(none, labels).count() == 0
    text = prose(3, 3000).encode()
    assert [w for part in op11.words_of(text, 100) for w in part] == text.split()
    assert op11.failures(text, len(text), 100) == op11.failures(text, len(text))
    assert op11.failures(b"", 0) == 1


# 12: chat
HARD = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "[", "<", "]", ">", "/", " ", "a", "é😀", "\n", "INST]", "s>", "[\\INST]"]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE]"]), st.lists(st.sampled_from(HARD), max_size=8).map("".join)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_op12_any_text_returns(turns):
    out = op12.compiled(op12.TEMPLATE).render([{"role": r, "text": t} for r, t in turns])
    text = "".join(out.parts)
    assert list(op12.read_turns(text)) == turns
    assert [op12.unescape(text[a:b]) for a, b in out.spans] == [t for r, t in turns if r == "assistant"]


def digests_of(rows):
    found = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((x is not None, x) if i < 2 else x or "" for i, x in enumerate(r))):
        found.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(op12.compiled(op12.TEMPLATE).render([{"role": r, "text": t} for r, t in turns]).parts)
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole))
    return out


@pytest.mark.parametrize("piece", [1, 40, 50_000])
def test_op12_digests(spark, piece):
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", None]), r.choice([None, "", "x" * 30, "</s>[INST] ok [/INST]", "日本", "y\\"])) for c in [*range(20), None, -7] for t in range(r.randint(1, 9))]
    rows += [(3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "assistant", "b"), (500, 1, "assistant", "long " * 100_000)]
    rows += [(99, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(3000)]  # one conversation holds most rows
    table = spark.createDataFrame([(*x, "k") for x in rows], "conv_id long, turn long, role string, text string, piece string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that conversations meet at tasks' edges
    got = {x[0]: tuple(x)[1:] for x in op12.format_digests(table, piece).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == digests_of(rows)


def test_op12_pieces_of_a_long_conversation_are_dealt_out(spark):
    rows = spark.createDataFrame([(1, t, "user", "x" * 100) for t in range(4000)], "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if there were more rows
    pieces = op12.formatted(rows, piece=1000).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({p.piece >> 33 for p in pieces}) > 1 and max(len(p.formatted) for p in pieces) < 1200
    assert sum(p.formatted.count("[/INST]") for p in pieces) == 4000 and not any(p.whole for p in pieces)


def test_op12_templates_over_whole_conversations(spark):
    rows = spark.createDataFrame([(c, t, "user" if t % 2 == 0 else "assistant", f"{c}.{t}") for c in range(3) for t in range(4)], "conv_id long, turn long, role string, text string")
    source = "<s>{% for m in messages %}{{ loop.index }}/{{ loop.length }}:{{ m.text }}{% if not loop.last %};{% endif %}{% endfor %}"
    got = {r.conv_id: r.formatted for r in op12.formatted(rows, source).collect()}
    assert got == {c: "<s>" + ";".join(f"{t + 1}/4:{c}.{t}" for t in range(4)) for c in range(3)}
    assert op12.format_digests(rows.limit(0)).count() == 0


def rendered(source, **given):
    out = Template(source).render(given.pop("messages", []), **given)
    return "".join(out.parts)


def test_template_language():
    assert rendered("a {{- ' b ' -}} c{# no #}") == "a b c"
    assert rendered("{% set x = 2 %}{{ x * 3 - 1 }} {{ 7 // 2 }} {{ 7 % 4 }} {{ -x }} {{ 'a' ~ 1 ~ none }}") == "5 3 3 -2 a1"
    assert rendered("{% if a and not b %}1{% elif b or c %}2{% else %}3{% endif %}", a=True, b=True) == "2"
    assert rendered("{{ 'y' if 'a' in s else 'n' }}{{ 'y' if 'q' not in s else 'n' }}", s="cat") == "yy"
    assert rendered("{% for x in xs %}{% if loop.first %}[{% endif %}{{ x.k|upper }}{{ ']' if loop.last else ',' }}{% endfor %}", xs=[{"k": "a"}, {"k": "b"}]) == "[A,B]"
    assert rendered("{{ x is defined }} {{ x is not none }} {{ y|default('d') }} {{ z[1] }} {{ z|join('-') }} {{ z|length }}", z=[1, 2]) == "false false d 2 1-2 2"
    assert rendered("{{ '}}' }}{{ \"%}\" }}") == "}}%}"
    assert Template("{% if 1 + 1 == 2 %}a{% else %}{{ x }}{% endif %}{{ 'b' ~ 'c' }}d").tree == Template("abcd").tree  # folded to one text
    out = Template("x{% generation %}yz{% endgeneration %}{% generation %}{% endgeneration %}").render([])
    assert out.spans == [(1, 3), (3, 3)] and isinstance(out, Output)


@pytest.mark.parametrize("source", ["{% if x %}", "{% endfor %}", "{{ }}", "{{ a b }}", "{{ __import__ }}", "{{ x | nothing }}", "{{ f(1) }}", "{% include 'x' %}", "{{ x is odd }}", "{{ 'a' * 9 }}", "{{ (1 }}"])
def test_template_errors(source):
    with pytest.raises(TemplateError):
        Template(source).render([])


def test_template_sandbox():
    assert rendered("{{ x.__class__ }}{{ x.upper }}{{ x['real'] }}", x="s") == ""
    with pytest.raises(TemplateError):
        rendered("{% for a in xs %}{% for b in xs %}{% for c in xs %}{% endfor %}{% endfor %}{% endfor %}", xs=list(range(1000)))


# 13: alignment
def aligned(texts, al):
    """By byte spans, straight from the definition."""
    (a_bytes, b_bytes), counts, kept = al.transducer.bytes, Counter(), []

    def spans(row, of):
        ends = list(itertools.accumulate(len(of[x]) for x in row))
        return list(zip([0, *ends], ends, row))

    for t in texts:
        a, b = (al.a.encode(" " + t, add_special_tokens=False).ids, al.b.encode(t)) if t else ([], [])
        want = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            kept.append(None)
            continue
        sa, sb = spans(a, a_bytes), spans(b, b_bytes)
        cuts = sorted({x[1] for x in sa} & {x[1] for x in sb})
        groups = [[[x[2] for x in s if lo <= x[0] and x[1] <= hi] for s in (sa, sb)] for lo, hi in zip([0, *cuts], cuts)]
        links = [(x[2], y[2]) for x in sa for y in sb if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        kept.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for k in kept:
        if k is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join("|".join(",".join(map(str, x)) for x in g) for g in k[2])
        out.append((k[0], k[1], len(k[2]), len(k[3]), sum(counts[x] == best[x[1]] for x in k[3]), sum(counts[x] for x in k[3]), hashlib.sha256(text.encode()).hexdigest()))
    return out


def odd_texts():
    r = random.Random(1)
    parts = [*"ab cd  \n\t,.'s1▁　é日😀<>|", "<|endoftext|>", "</s>", "<0x41>", "  ", "\x00", " ", "\u0085", "don't", "İ", "ﬁ"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(200)]


@pytest.mark.parametrize("block_bytes", [200, 4_000_000])
def test_op13_against_spans(spark, block_bytes):
    rows = [(i, t if t is None else t[:2500]) for i, t in awkward()] + [(100 + i, t) for i, t in enumerate(odd_texts())] + [(None, "no id")]
    paths = public_tokenizers.path(A), public_tokenizers.path(B)
    got = [tuple(r) for r in op13.alignment(documents(spark, rows), *paths, block_bytes).collect()]
    want = [(i, *x) for (i, _), x in zip(rows, aligned([t for _, t in rows], op13.aligner(*paths)))]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[1] == 0 for r in want) > 5 and sum(r[1] > 0 for r in want) > 100


def test_op13_without_splitting_and_with_few_kept(monkeypatch):
    paths = public_tokenizers.path(A), public_tokenizers.path(B)
    texts = odd_texts() + [prose(1, 300)]
    one, other = op13.Aligner(*paths), op13.Aligner(*paths)
    other.splits = False
    monkeypatch.setattr(op13, "KEPT", 3)
    monkeypatch.setattr(op13, "STEPS", 5)
    a, b = one.block(texts), other.block(texts)
    assert all(list(a[c]) == list(b[c]) for c in a)


def test_op13_very_long_and_empty(spark):
    paths = public_tokenizers.path(A), public_tokenizers.path(B)
    text = prose(8, 400_000) + " " + "x" * 100_000
    rows = op13.alignment(documents(spark, [(1, text), (2, "the")]), *paths).collect()
    got = {r.doc_id: r for r in rows}
    assert got[1].n_links == got[1].n_a + got[1].n_b - got[1].n_groups > 500_000 and got[2].n_groups == 1
    assert op13.alignment(documents(spark, [(1, text)]).limit(0), *paths).count() == 0
