"""Base spans against the stated patterns; bootstrapped spans on a planted corpus."""

import hashlib
import random
import re
import time

from tests.llm.conftest import SF, table
from vistra.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def ok(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m[0])]


def named(spans):
    return [(pii.KINDS[k], a, b) for k, a, b in spans]


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    pool = ["a", "B.", "@", "@x.y", "1.2.3.4", "255.256", ".", "-", " ", "+1", "+49 (30) 1234567", "4465758382889437", "0", "12", "é", "%", "5 5", "4111 1111 1111 1111", "(", "\n", "..", "0001.2.3.4"]
    for _ in range(20_000):
        t = "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))
        assert named(pii.base_spans(t)) == brute(t), t


def test_long_runs_take_linear_time():
    began = time.process_time()
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "x" * 100_000 + " " + "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "+1 (" + "(" * 200_000, "1 " * 100_000):
        pii.mentions(t, pii.base_spans(t))
    assert time.process_time() - began < 60  # minutes, if each place read its whole word again


def check(rows, texts):
    for r in rows:
        base = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(",")) | {""} or not base


def test_op1_on_documents(spark):
    docs = table("documents")
    rows = pii.op1_bootstrapped_pii(spark, SF).collect()
    assert len(rows) == len(docs)
    check(rows, dict(zip(docs.doc_id, docs.text)))


def planted():
    rng = random.Random(9)
    rows = []
    for i in range(40):
        rows.append((i, f"please write to user{i}@mail{i}.example.com for details {i}", "c"))
    # the same surroundings, but an address the rules can't see
    rows.append((100, "please write to odd.name@localhost for details", "c"))
    # identifier-like tokens in surroundings without seeds
    rows += [(200 + i, f"the serial number {rng.randint(10**7, 10**8)} was printed", "c") for i in range(20)]
    rows += [(300 + i, "plain words without anything of note", "c") for i in range(20)]
    return rows


def test_patterns_discover_unseen_identifiers(spark):
    docs = spark.createDataFrame(planted(), "doc_id bigint, text string, base string")
    rows = {r.doc_id: r for r in pii.digest(pii.find_pii(docs.drop("base"))).collect()}
    assert rows[100].n_email == 0
    a = "please write to odd.name@localhost for details".index("odd")
    assert rows[100].spans == f"email:{a}:{a + len('odd.name@localhost')}"
    assert all(rows[i].spans == "" for i in rows if i >= 200)
    assert all(rows[i].n_email == 1 for i in range(40))
    assert all(r.n_spans == len(r.spans.split(",")) if r.spans else r.n_spans == 0 for r in rows.values())


def test_values_hidden_from_the_rules_are_found_by_their_surroundings(spark):
    docs = spark.createDataFrame(planted(), "doc_id bigint, text string, base string")
    rows = pii.hidden_recall(docs.drop("base")).collect()
    assert [r.kind for r in rows] == ["email"]  # numbers in the texts are no seeds, so none can be hidden
    assert 1 <= rows[0].hidden <= 7 and rows[0].found == rows[0].right == rows[0].hidden
    assert pii.hidden_recall(docs.limit(0)).count() == 0


def test_rounds_are_written_together_after_some(spark, monkeypatch):
    monkeypatch.setattr(pii, "ROUNDS_APART", 2)
    test_rounds_go_on_until_nothing_new_is_sure(spark)


def unseen(text):
    return [text[a:b] for _, a, b, _, _ in (m for m in pii.mentions(text, pii.base_spans(text)) if m[0] < 0)]


def test_likely_identifiers_have_the_shape_of_seeds():
    assert unseen("call 663 555 6869 for") == ["663 555 6869"]
    assert unseen("call (663) 555-6869, or (663 555 6869).") == ["(663) 555-6869", "663 555 6869"]
    assert unseen("card 4111 1111 1111 1112 no") == ["4111 1111 1111 1112"]
    assert unseen("to bob at host dot org for") == ["bob at host dot org"]
    assert unseen("to bob dot b [at] host(dot)co.uk. At home") == ["bob dot b [at] host(dot)co.uk"]
    assert unseen("663 - 555 / 6869 and 12 . 34 . 56") == ["663 - 555 / 6869", "12 . 34 . 56"]
    assert unseen("x" * 70 + "@localhost") == ["x" * 70 + "@localhost"]
    assert unseen("serial AB1234567, 12 34\n56 78, look at 10.30 at home. Dot") == ["AB1234567"]
    assert unseen("a.b@c.de 663 555 6869 1.2.3.4 123 4567") == ["663 555 6869", "123 4567"]
    for t in ("1 " * 100_000, "a at " * 50_000, "a dot " * 50_000 + "at b dot c", "( " * 100_000, "at " + " " * 200_000, "a at b dot " * 30_000, "(1) - " * 50_000, "at b.c " * 50_000):
        pii.mentions(t, pii.base_spans(t))


def test_identifiers_of_several_tokens_are_found_and_masked(spark):
    rng = random.Random(5)
    rows = []
    for i in range(20):
        rows.append((i, f"please call us on +1 ({rng.randint(200, 999)}) 555-{1000 + i} for a quote {i}", ""))
        rows.append((100 + i, f"now write to user{i}@mail{i}.example.com with your details {i}", ""))
        digits = f"411111{rng.randint(10**8, 10**9 - 1)}"
        digits += next(c for c in "0123456789" if pii.luhn(digits + c))
        rows.append((200 + i, f"pay with card {digits[:4]} {digits[4:8]} {digits[8:12]} {digits[12:]} before the end {i}", ""))
    rows += [
        (300, "please call us on 663 555 6869 for a quote", "please call us on [PHONE] for a quote"),
        (301, "please call us on (663) 555-6869 for a quote", "please call us on [PHONE] for a quote"),
        (302, "pay with card 4111 1111 1111 1112 before the end", "pay with card [CARD] before the end"),
        (303, "now write to bob at host dot org with your details", "now write to [EMAIL] with your details"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, want string")
    found = pii.mask_spans(pii.find_pii(docs, keep=["doc_id", "text", "want"]).filter("doc_id >= 300")).collect()
    assert len(found) == 4
    assert [(r.doc_id, r.text) for r in found if r.text != r.want] == []


def test_rounds_go_on_until_nothing_new_is_sure(spark):
    # what a round finds makes the patterns of the next one good, five times
    sizes = [5 ** (6 - k) for k in range(6)]
    rows = [(0 if k == 0 else -1, f"v{k}-{i}", [f"p{k + s}-{j}" for s in (0, 1) for j in (0, 1)]) for k, n in enumerate(sizes) for i in range(n)]
    seen = spark.createDataFrame(rows, "kind int, value string, patterns array<string>")
    sure, _ = pii.bootstrap(seen)
    assert sorted((r.value, r.kind) for r in sure.collect()) == sorted((v, 0) for kind, v, _ in rows if kind < 0)


def test_odd_rows_and_masks(spark, odd_docs):
    extra = spark.createDataFrame([(50, "call +1 (663) 555-6869 or mail a.b@c.de, card 4465758382889437", "z", 1)], odd_docs.schema)
    docs = odd_docs.unionByName(extra)
    found = pii.find_pii(docs, keep=["doc_id", "text", "lang", "part"])
    assert found.count() == docs.count()
    masked = {r.doc_id: r.text for r in pii.mask_spans(found).filter("doc_id in (50, 1, 0)").collect()}
    assert masked[50] == "call [PHONE] or mail [EMAIL], card [CARD]"
    assert masked[1] is None and masked[0] == ""
    assert pii.digest(pii.find_pii(docs.limit(0))).count() == 0


def test_context_words_are_whole():
    from vistra.llm.pii import Context

    a, b = "x" * 40 + "a", "x" * 40 + "b"
    text = f"{a} tel: 123 {b}  {'y' * 500} end"
    at = text.index("123")
    context = Context(text)
    assert context.before(at)[1] == "tel:" and context.after(at + 3)[0] != context.before(at)[0]  # two long words are two words
    assert context.after(at + 3)[1] != "y" * 200 and len(context.after(at + 3)[1]) <= 41
    word = "Ab9" + "".join(random.Random(4).choice("abXY01é中") for _ in range(200_000))  # over several blocks
    for i, j in ((0, 100), (65_500, 65_600), (65_536, 200_003), (100_000, 131_080), (7, 199_999)):
        part = word[i:j]
        assert Context("k " + word).after(2 + i)[0] == Context("k " + word[i:]).after(2)[0]  # a part is named as if it stood alone
        assert Context(word).before(j)[-1] == Context(word[:j]).before(j)[-1]
        assert Context(part).before(len(part)) != Context(part[:-1] + "z").before(len(part))
    assert Context("tel:+123;x").before(4) == ["tel:"] and Context("tel:+123;x").after(8) == [";x"]
    assert Context("a").before(0) == [] and Context("").after(0) == []
