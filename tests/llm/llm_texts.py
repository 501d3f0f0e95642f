"""Texts for the tests of this folder."""


def texts_with_everything(seed=3, n=120):
    """Small texts with copies, near copies, shared passages, nulls and oddities."""
    import random

    rng = random.Random(seed)
    words = ["la", "été", "Größe", "the", "a", "river", "stone", "über", "Zeit", "x1", "cc", "by", "all", "rights", "reserved", "don't", "…", "你好", "<|endoftext|>"]
    make = lambda k: " ".join(rng.choice(words) + rng.choice(["", ",", ".", "s"]) for _ in range(k))
    passage = make(30)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.35 or not rows:
            rows.append(make(rng.randint(1, 90)))
        elif kind < 0.55:
            rows.append(rng.choice(rows))
        elif kind < 0.75:
            w = (rng.choice(rows) or "").split(" ")
            w[rng.randrange(len(w))] = "changed"
            rows.append(" ".join(w))
        elif kind < 0.9:
            rows.append(make(rng.randint(0, 20)) + " " + passage + " " + make(rng.randint(0, 20)))
        else:
            rows.append(rng.choice([None, "", " ", "\n\t", "a" * 400, "ab " * 150, "one", "one two three four", "é" * 60]))
    out = [(i, t) for i, t in enumerate(rows)]
    out += [out[3], out[4]]  # repeated rows
    out.append((None, make(40)))
    out.append((None, out[2][1]))
    return out
