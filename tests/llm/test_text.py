"""Quality, secrets, chat formatting and language-model scores."""

import hashlib
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from boxstar.llm import chatpairs, pll, quality, secrets
from boxstar.llm.registered import op1_lm_scoring, op2_chat_formatting, op4_quality_classifier, op8_secret_scans

from .conftest import SF, awkward_texts

# -- quality ------------------------------------------------------------------------------


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(0)
    n, accuracy = 20_000, np.array([0.95, 0.9, 0.85, 0.7, 0.9, 0.8])
    truth = rng.random(n) < 0.7
    votes = np.where(rng.random((n, 6)) < accuracy, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    votes[rng.random((n, 6)) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_labels(patterns, counts.astype(float))
    assert model.good == pytest.approx(0.7, abs=0.02)
    assert model.accuracies() == pytest.approx(accuracy, abs=0.03)
    right = (model.posterior(votes) >= 0.5) == truth
    assert right.mean() > 0.93


def test_op4_against_held_out_labels(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = {r.doc_id: r for r in op4_quality_classifier(spark, sf).collect()}
        labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
        good = [rows[d].keep for d, q in labels if q == 1]
        bad = [rows[d].keep for d, q in labels if q == 0]
        assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05
        assert len(rows) == duckdb.sql(f"SELECT count(*) AS n FROM '{sf}/documents.parquet'").df().n[0]


def test_op4_scores_follow_the_model(spark, small_docs):
    df = spark.createDataFrame(small_docs, "doc_id long, text string").repartition(2)
    model = quality.label_model(df)
    weights = quality.train_scorer(df, model)
    rows = {r.doc_id: r for r in quality.classify(df).collect()}
    for doc, text in small_docs[:60]:
        assert rows[doc].weak_label == pytest.approx(float(model.posterior(np.array([quality.votes(quality.statistics(text))]))[0]))
        assert rows[doc].score == pytest.approx(quality.score_text(text, weights), abs=0.05)
        assert rows[doc].keep == (rows[doc].score >= 0.5)


def test_op4_awkward(spark, awkward, no_docs):
    rows = quality.classify(awkward).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in awkward_texts())
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.score, r.weak_label, r.keep) == (0.0, None, False)
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns
    assert all(r.text and r.text.strip() for r in kept.collect())
    assert quality.classify(no_docs).collect() == [] and quality.keep_good(no_docs).collect() == []


# -- secrets ------------------------------------------------------------------------------


def brute_base(text):
    spans = []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_op8_whole_table(spark):
    for sf in (SF, "/root/testdata/sf0.1"):
        texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf}/documents.parquet'").fetchall())
        rows = op8_secret_scans(spark, sf).collect()
        assert len(rows) == len(texts)
        for r in rows:
            base = brute_base(texts[r.doc_id])
            shown = secrets.render(base)
            assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
            assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
            assert set(filter(None, shown.split(","))) <= set(r.spans.split(","))


def test_op8_awkward(spark, awkward, no_docs):
    rows = secrets.scan_documents(awkward).collect()
    assert Counter((r.doc_id, r.base_sha256) for r in rows) == Counter(
        (i, hashlib.sha256(secrets.render(brute_base(t or "")).encode()).hexdigest()) for i, t in awkward_texts()
    )
    assert secrets.scan_documents(no_docs).collect() == []
    hidden = secrets.redact_documents(awkward)
    assert hidden.columns == awkward.columns
    for r in hidden.collect():
        if r.doc_id == 10:
            assert r.text == "[REDACTED]\" and [REDACTED] and [REDACTED]" and r.n_chars == len(r.text)
    assert secrets.redact_documents(no_docs).collect() == []


KEY = "q7Zx9LmP2vRt8Kd4"


@pytest.mark.parametrize(
    "text",
    [
        f'db_passphrase = "{KEY}"',
        f"credentials: '{KEY}'",
        f'{{"client_credential": "{KEY}"}}',
        f"<privateKey>{KEY}</privateKey>",
        f"export SIGNING_KEY={KEY}\n" * 1,
        f'config["access_key"] = "{KEY}"',
        f"tool --access-key {KEY} run",
        f'first = "{KEY}"\nmy_password = first',
        f'const a = "{KEY[:8]}" + "{KEY[8:]}";\nlet private_key = a;',
        f"user := `{KEY}`\ncredential => user",
    ],
)
def test_lexer_finds_literals_by_their_names(text):
    spans = secrets.lexed_spans(text)
    assert "".join(text[a:b] for a, _, b in spans) in (KEY, KEY[:8] + KEY[8:])


@pytest.mark.parametrize(
    "text",
    [
        f'colour = "{KEY}"',
        'passphrase = "changeme"',
        'credential = "${VAULT_CREDENTIAL}"',
        'passphrase = ""',
        "the private key: a story about a door",
        'passphrase = "two words here"',
        'if credential == "' + KEY + '": pass',
        "credential: str = None",
        "no assignment of a credential here",
    ],
)
def test_lexer_leaves_other_text_alone(text):
    assert secrets.lexed_spans(text) == []


PEM = f"-----BEGIN RSA PRIVATE KEY-----\n{KEY}\n{KEY}\n-----END RSA PRIVATE KEY-----"
WHOLE = [
    (f'db_password: str = "{KEY}"', KEY),
    ('password: str = "hunter2xyz9"', "hunter2xyz9"),
    ('const apiKey: string = "Zk3mQ9wLx71b"', "Zk3mQ9wLx71b"),
    (f'secret: Optional[str] = "{KEY}"', KEY),
    (f'def f(n: int, token: dict[str, "T"] | None = "{KEY}", m: int = 3):', KEY),
    (f'let access_key: &str = "{KEY}";', KEY),
    (f"let credential: Option<Map<String, String>>= '{KEY}';", KEY),
    (f'var privateKey: String? = "{KEY}"', KEY),
    (f'class A {{ apiKey?: string = "{KEY}" }}', KEY),
    (f'if ready: password = "{KEY}"', KEY),
    (f"credential: {KEY}=", KEY + "="),
    (f'private_key = """\n{KEY}\n{KEY}\n"""', f"{KEY}\n{KEY}"),
    (f"credential: bytes = b\'\'\'{KEY}\'\'\'", KEY),
    (f"const privateKey = `\n{KEY}\n`;", KEY),
    (f"a:\n  private_key: |-\n    {KEY}\n\n    {KEY}\n  colour: blue", f"{KEY}\n\n    {KEY}"),
    (f'final String credential =\n    "{KEY}";', KEY),
    (f'passphrase = "word {KEY} word"', f"word {KEY} word"),
    (f"see {PEM} there", PEM),
]


@pytest.mark.parametrize("text, literal", WHOLE)
def test_lexer_reads_typed_and_long_literals(text, literal):
    assert literal in {text[a:b] for a, _, b in secrets.lexed_spans(text)}


def test_typed_and_long_literals_through_op8_and_redaction(spark):
    planted = [(i, text) for i, (text, _) in enumerate(WHOLE)]
    docs = spark.createDataFrame(planted, "doc_id long, text string").repartition(2)
    found = {r.doc_id: r for r in secrets.scan_documents(docs).collect()}
    hidden = {r.doc_id: r.text for r in secrets.redact_documents(docs).collect()}
    for i, text in planted:
        start, end = text.index(WHOLE[i][1]), text.index(WHOLE[i][1]) + len(WHOLE[i][1])
        spans = [tuple(map(int, s.split(":")[1:])) for s in found[i].spans.split(",")]
        assert any(a <= start and end <= b for a, b in spans), text
        assert WHOLE[i][1] not in hidden[i] and secrets.REDACTED in hidden[i]


@pytest.mark.parametrize("text", [f'colour: str = "{KEY}"', 'secret: str = """please write\nit down"""', "credential: |\n  none of\n  your business"])
def test_lexer_leaves_typed_and_long_text_alone(text):
    assert secrets.lexed_spans(text) == []


@pytest.mark.parametrize(
    "text",
    [
        """don't set passphrase = "Zk3mQ9wLx71b" as it's bad""",
        "user's passphrase = Zk3mQ9wLx71b  # it's",
        'const dbCredential string = "Zk3mQ9wLx71b"',
        "passphrase = b'Zk3mQ9wLx71b'",
        r"""log "{\"note\": 1, then passphrase = 'Zk3mQ9wLx71b' and \"more\": 2""",
        "it's 5' wide, passphrase='Zk3mQ9wLx71b'",
    ],
)
def test_marks_beside_literals_through_op8_and_redaction(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = secrets.scan_documents(df).collect()
    found = [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in row.spans.split(","))]
    assert any("Zk3mQ9wLx71b" in f for f in found)
    assert "Zk3mQ9wLx71b" not in secrets.redact_documents(df).first().text


LONG_TEXTS = {
    "escaped double quotes": "token " + '{\\"a\\":\\"b\\",}' * 70_000,
    "escaped single quotes": "token " + "{\\'a\\':\\'b\\',}" * 70_000,
    "colons": "token " + "a:" * 500_000,
    "equals": "token " + "a=" * 500_000,
    "joins": "key password = " + "'a'+" * 250_000,
    "backslashes": "key '" + "\\" * 1_000_000,
    "doubled names": "key a='Zk3mQ9wLx71b'\n" + "a=a+a\n" * 5_000 + "password=a\n",
    "found and base": "password=abcdef1 passphrase='Zk3mQ9wLx71b' " * 25_000,
}


@pytest.mark.parametrize("name", LONG_TEXTS)
def test_a_megabyte_takes_seconds(name):
    began = time.process_time()
    secrets.scan(LONG_TEXTS[name])
    assert time.process_time() - began < 30  # the quadratic reading took hours


def test_unclosed_quotes_are_read_as_before():
    """What is kept of a failed reading changes no token: against one reading for each place."""
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(['"', "'", "\\", "a", "b", " ", "=", ":", "\n", "`", ","]) for _ in range(rng.randint(0, 40)))
        want, at = [], 0
        while at < len(text):
            apostrophe = text[at] == "'" and at and text[at - 1].isalnum() and not (want and want[-1] in ("b",) and text[at - 1] == "b")
            m = (secrets._MARK if apostrophe else secrets._LEX).match(text, at)
            at = m.end()
            if m.lastgroup != "space":
                want.append(m[0])
        assert [m[0] for _, m in secrets._tokens(text)] == want


def test_ascii_case_only():
    assert brute_base("toKen=abcdefgh") == [] == secrets.base_spans("toKen=abcdefgh")
    assert secrets.base_spans("ToKeN=abcdefgh") == [(0, 0, 14)]


# -- chat ---------------------------------------------------------------------------------


def brute_pairs(rows):
    turns = {}
    for c, t, role, text in sorted(set(rows), key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    groups = {}
    for c in sorted(turns):
        groups.setdefault(turns[c][0], []).append(c)
    show = lambda ts: "".join(f"<|{r}|>\n{t}\n" for r, t in ts)

    def mask(ts):
        at, out = 0, []
        for r, t in ts:
            a = at + len(r) + 5
            at = a + len(t) + 1
            if r == "assistant":
                out.append(f"{a}:{at}")
        return ",".join(out)

    out = Counter()
    spoken = lambda c: sum(len(t) for r, t in turns[c] if r == "assistant")
    for ids in groups.values():
        for i in range(0, len(ids), 2):
            two = sorted(ids[i : i + 2], key=lambda c: (-spoken(c), c))
            c, r = turns[two[0]], turns[two[1]] if len(two) > 1 else []
            k = 0
            while k < min(len(c), len(r)) and c[k] == r[k]:
                k += 1
            out[(two[0], two[1] if len(two) > 1 else None, k, show(c[:k]), show(c[k:]), show(r[k:]), mask(c[k:]), mask(r[k:]))] += 1
    return out


def _conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("opening", F.lit("clash"))


def test_op2_pairs_against_brute_force(spark):
    rows = []
    for c in range(60):
        rows.append((c, 0, "user", f"hello {c % 7}"))
        rows.append((c, 1, "assistant", "same answer" if c % 3 else f"answer {c}"))
        if c % 2:
            rows.append((c, 2, "user", None))
        if c % 4 == 0:
            rows += [(c, 3, None, "noise"), (c, 3, None, "noise")]
    rows += [(100, 0, "user", "alone"), (5000, 0, "user", "hello 1"), (5001, 0, "user", "hello 1")]
    got = chatpairs.preference_pairs(_conversations(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == brute_pairs(rows)
    masked = next(r for r in got if r.chosen_mask)
    a, b = map(int, masked.chosen_mask.split(",")[0].split(":"))
    assert masked.chosen[:a].endswith("<|assistant|>\n") and masked.chosen[b - 1] == "\n"


def test_op2_whole_table(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert Counter(tuple(r) for r in op2_chat_formatting(spark, SF).collect()) == brute_pairs(rows)
    assert chatpairs.preference_pairs(_conversations(spark, [])).collect() == []


def test_op2_oracle_on_shared_openings(spark):
    rows = [(c, t, r, x) for c in range(9) for t, (r, x) in enumerate([("user", f"q{c % 2}"), ("assistant", "a" * (c % 3 + 1)), ("user", "end")])]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cur = con.execute(chatpairs.ORACLE_SQL)
    names = [d[0] for d in cur.description]
    spark_rows = chatpairs.preference_pairs(_conversations(spark, rows)).select(*names).collect()
    assert Counter(cur.fetchall()) == Counter(tuple(r) for r in spark_rows)


def test_op2_copies_as_one(spark):
    rows = [(c, t, r, x) for c, answer in ((4, "A"), (7, "A"), (9, "Bb"), (11, "Bb"), (12, "A"), (None, "A"))
            for t, (r, x) in enumerate([("user", "q"), ("assistant", answer)])]
    df = _conversations(spark, rows)
    got = chatpairs.preference_pairs(df, distinct=True).collect()
    assert [(r.chosen_id, r.rejected_id, r.prompt_turns, r.chosen, r.rejected) for r in got] == [
        (9, 4, 1, "<|assistant|>\nBb\n", "<|assistant|>\nA\n")
    ]
    turns = chatpairs.conversation_turns(df)
    assert {(r.conv_id, r.class_id) for r in chatpairs.copies_of_each(turns).collect()} == {(4, 4), (7, 4), (12, 4), (None, 4), (9, 9), (11, 9)}
    assert {(r.conv_id, r.copies) for r in chatpairs.one_of_each(turns).collect()} == {(4, 4), (9, 2)}


def test_op2_hot_opening_with_sparse_ids(spark):
    rows = [(c * 1_000_003, t, r, x) for c in range(900) for t, (r, x) in enumerate([("user", "q" if c % 3 else f"q{c}"), ("assistant", "a" * (c % 5))])]
    assert Counter(tuple(r) for r in chatpairs.preference_pairs(_conversations(spark, rows)).collect()) == brute_pairs(rows)


def test_op2_null_conversation(spark):
    got = chatpairs.preference_pairs(_conversations(spark, [(None, 0, "user", "x"), (1, 0, "user", "x")])).collect()
    assert [(r.chosen_id, r.rejected_id, r.prompt_turns) for r in got] in ([(None, 1, 1)], [(1, None, 1)])


# -- language model -----------------------------------------------------------------------


def test_probabilities_sum_to_one():
    p = pll.unflatten(pll.initial(np.random.default_rng(0).integers(1, 9, pll.CODES)))
    around = np.array([pll.EDGE, 5, 0, 17, pll.EDGE])
    total = 0.0
    for code in range(pll.CODES):
        around[2] = code
        total += np.exp(pll.log_probabilities(p, around, np.array([2]))[0])
    assert total == pytest.approx(1, abs=1e-4)


def test_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    flat = pll.initial(rng.integers(1, 9, pll.CODES)).astype(np.float64)
    codes = np.concatenate([[pll.EDGE] * 2, rng.integers(0, pll.CODES, 30), [pll.EDGE] * 2])
    at = np.arange(2, 32)
    g = pll.gradient(pll.unflatten(flat.astype(np.float32)), codes, at, len(flat))
    loss = lambda f: -pll.log_probabilities(pll.unflatten(f), codes, at).mean()
    for i in np.argsort(-np.abs(g))[:20]:
        step = np.zeros_like(flat)
        step[i] = 1e-4
        assert (loss(flat + step) - loss(flat - step)) / 2e-4 == pytest.approx(g[i], rel=0.05, abs=1e-4)


def test_training_helps_and_both_sides_matter(spark):
    rng = np.random.default_rng(2)
    rows = []
    for d in range(300):  # each word tells the next one, four times in five
        w, words = int(rng.integers(0, 40)), []
        for _ in range(100):
            words.append(f"w{w}")
            w = (w * 7 + 3) % 40 if rng.random() < 0.8 else int(rng.integers(0, 40))
        rows.append((d, " ".join(words)))
    train, held = spark.createDataFrame(rows[:250], "doc_id long, text string"), spark.createDataFrame(rows[250:], "doc_id long, text string")
    codes, counts = pll.code_table(train)
    mean = lambda flat: pll.score(held, codes, flat).agg(F.avg("mean_pll")).first()[0]
    frequencies, flat = mean(pll.initial(counts)), pll.train(train, codes, counts)
    trained = mean(flat)
    assert trained > frequencies + 0.3
    for sides in ((0, 1), (2, 3)):  # without the left, without the right window
        half = flat.copy()
        pll.unflatten(half)["places"][list(sides)] = 0
        assert mean(half) < trained - 0.05


def test_op1_sums_each_token_once(spark, small_docs):
    df = spark.createDataFrame(small_docs, "doc_id long, text string").repartition(3)
    codes, counts = pll.code_table(df)
    assert counts.sum() == sum(len(t.lower().split()) for _, t in small_docs)
    flat = pll.train(df, codes, counts)
    p = pll.unflatten(flat)
    rows = {r.doc_id: r for r in pll.score(df, codes, flat).collect()}
    table = codes.tolist()
    for doc, text in small_docs[:40]:
        words = [table[pll._slot(w)] for w in text.lower().split()]
        padded = np.array([pll.EDGE] * 2 + words + [pll.EDGE] * 2)
        want = sum(pll.log_probabilities(p, padded, np.array([i + 2]))[0] for i in range(len(words)))
        assert rows[doc].n_tokens == len(words) and rows[doc].pll == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_op1_whole_and_awkward(spark, awkward, no_docs):
    assert op1_lm_scoring(spark, SF).where("pll < 0 AND pseudo_perplexity > 1").count() == 200
    rows = pll.pseudo_likelihood(awkward).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((i, len((t or "").lower().split())) for i, t in awkward_texts())
    assert all((r.pll, r.mean_pll) == (0.0, None) for r in rows if r.n_tokens == 0)
    assert pll.pseudo_likelihood(no_docs).collect() == []


def test_op1_random_strings_score_below_real_text(spark, small_docs):
    rng = np.random.default_rng(5)
    odd = [(-1 - i, " ".join("".join(map(chr, rng.integers(97, 123, 9))) for _ in range(200))) for i in range(5)]
    df = spark.createDataFrame(small_docs + odd[:3], "doc_id long, text string").repartition(3)
    words = pll.word_table(df)
    exact = Counter(w for _, t in small_docs + odd[:3] for w in t.lower().split())
    assert {r.word: r.n for r in words.collect()} == exact
    codes, counts = pll.code_table(df, words)
    flat = pll.train(df, codes, counts)
    held = spark.createDataFrame(small_docs + odd, "doc_id long, text string")
    rows = {r.doc_id: r for r in pll.score_words(held, codes, flat, words, counts, head=300).collect()}
    worst_real = min(rows[d].mean_pll for d, t in small_docs if t.split())
    assert max(rows[d].mean_pll for d, _ in odd) < worst_real  # seen once or never
    p, table = pll.unflatten(flat), codes.tolist()
    for doc, text in small_docs[:10] + odd[-1:]:  # words with broadcast counts, joined counts, and unseen ones
        tokens = text.lower().split()
        own = [table[pll._slot(w)] for w in tokens]
        around = np.array([pll.EDGE] * 2 + own + [pll.EDGE] * 2)
        want = pll.log_probabilities(p, around, np.arange(2, len(own) + 2)).sum()
        want += sum(np.log(max(1, exact[w])) - np.log(counts[c] + 1) for w, c in zip(tokens, own))
        assert rows[doc].pll == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_op1_codes_grow_with_the_frequent_words(spark):
    words = spark.createDataFrame([(f"w{i}", 2000 if i < 3000 else 2) for i in range(5000)], "word string, n long")
    codes, counts = pll.code_table(None, words)
    assert len(counts) > 3000 and counts.sum() == 3000 * 2000 + 2000 * 2
    flat = pll.initial(counts)
    assert pll.unflatten(flat)["places"].shape[1] == len(counts) + 1
    assert len({int(codes[pll._slot(f"w{i}", len(codes))]) for i in range(3000)}) > 2900
