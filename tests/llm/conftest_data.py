"""Small corpora that the tests share."""

import random

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n=120, seed=3):
    """Documents with copies, near copies, shared passages of over 50 words, short and odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passages = ["\n".join(sentence(20) for _ in range(3)) for _ in range(2)]
    texts = []
    for i in range(n):
        kind = i % 8
        if kind < 4 or not texts:
            text = "\n".join(sentence(rng.randint(3, 40)) for _ in range(rng.randint(1, 8)))
        elif kind == 4:
            text = rng.choice(texts)
        elif kind == 5:
            words = rng.choice(texts).split(" ")
            words[rng.randrange(len(words))] = "edited"
            text = " ".join(words)
        elif kind == 6:
            text = "\n".join([sentence(9), rng.choice(passages), sentence(7)])
        else:
            text = sentence(rng.randint(1, 6))
        texts.append(text)
    return [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(texts)]


ODD = [
    (None, "no id at all but some words to read", "en", None, 1),
    (900, None, None, "s1", None),
    (901, "", "en", "s1", 0),
    (902, " \n\t \x0b ", "en", None, 5),
    (903, "one", "de", "s2", 3),
    (904, "é ß 日本語 \U0001f600 x\x1cy <|endoftext|> Don't", "fr", "s2", 9),
    (905, "twice the same row of words here\nand a second line", "en", "s3", 4),
    (905, "twice the same row of words here\nand a second line", "en", "s3", 4),
    (906, "long " * 3000 + "\n" + "word" * 2000, "en", "s3", 4),
    (907, "123 456 !!!", "en", "s3", 4),
]

