import random

import pytest



@pytest.fixture(scope="module")
def corpus():
    return make_corpus()


def make_corpus(seed=1, n=60):
    """(id, text) rows with copies, near copies, shared passages, repeated lines and edge cases."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["été", "Ünï", "日本", "A-b", "x|y"]
    sentence = lambda k: " ".join(r.choice(words) for _ in range(k))
    passage = sentence(60)
    texts = []
    for k in range(n):
        lines = [sentence(r.randint(1, 30)) for _ in range(r.randint(1, 8))]
        if k % 5 == 0:
            lines.insert(len(lines) // 2, passage)
        texts.append("\n".join(lines))
    texts += [texts[3], texts[3], texts[7]]
    for k in (10, 10, 10, 11, 12):
        w = texts[k].split(" ")
        w[r.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += ["", None, "one", "a b c d e", "A B C D E", "  \n\t ", "ab" * 1500, "ab" * 900, "x\ny\nz\nx\ny\nz\nx\ny\nz"]
    texts += [" ".join(f"n{k % 977}" for k in range(30_000))]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    return rows
