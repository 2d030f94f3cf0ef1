"""Rows that the tests of the operators share."""

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "kept boolean, n_words bigint, node bigint, bucket bigint, start int, spans string, component bigint, h bigint")
#: Values of the columns that clash with names the operators use themselves.
CLASH = (True, -1, -1, -1, -1, "x", -1, -1)

_SYLLABLES = "ka lo mi tu re sa no vi du pe ra ti".split()


def word(rng, n=3):
    return "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, n)))


def sentence(rng, n):
    return " ".join(word(rng) for _ in range(n))


def corpus(seed=5):
    """(doc_id, text) rows with copies, near copies, passages, short, blank, long and odd texts."""
    rng = random.Random(seed)
    texts = [sentence(rng, rng.randint(1, 160)) for _ in range(40)]
    base = sentence(rng, 200)
    texts += [base] * 6                                            # exact copies
    for k in range(30):                                            # near copies, more and more edits
        w = base.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = word(rng, 4)
        texts.append(" ".join(w))
    passage = sentence(rng, 70)
    texts += [sentence(rng, 30) + " " + passage + "\n" + sentence(rng, 20) for _ in range(8)]
    texts += [passage.upper(), passage, "a " * 130, "a " * 60, "b a " * 70, base + " " + base, passage + " " + passage]
    texts += [None, "", " \n\t ", "x", "x y", "X Y", "é", "日本 語", " ", "#" * 40, "end\n" * 30]
    texts += [sentence(rng, 9000), "z" * 30000, sentence(rng, 60).replace(" ", "  ")]
    return [(i * 3 % 997, t) for i, t in enumerate(texts)]
