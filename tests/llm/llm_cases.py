import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, id long, block int, known boolean"


def invented(seed: int, n_docs: int = 60, vocabulary: int = 40) -> list[tuple[int, str]]:
    """Documents of frequent words with copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(vocabulary)]
    prose = lambda n: " ".join(rng.choices(vocab, k=n)) if n else ""
    passage, texts = prose(60), []
    for i in range(n_docs):
        kind, own = rng.randrange(6), prose(rng.choice([0, 1, 5, 34, 35, 36, 90, 300]))
        if kind == 0 and texts:
            own = rng.choice(texts)
        elif kind == 1 and texts:
            parts = rng.choice(texts).split(" ")
            parts[rng.randrange(len(parts))] = "changed" + str(i)
            own = " ".join(parts)
        elif kind == 2:
            own = own + "\n" + passage + "\t" + prose(7)
        elif kind == 3:
            own = own[:20] + " " + passage[40:250] + own
        texts.append(own)
    return list(enumerate(texts))


def plain(docs):
    """(doc_id, text) rows on the driver."""
    return [(r[0], r[1]) for r in docs.select("doc_id", F.col("text")).collect()]
