"""The second pass against plain code: each ambiguous block looks outwards by itself."""

import random

from loomwick.llm import html_extraction as op

STOPS = "the cat and the dog were in the house with a bird that it was of no use to them "
PIECES = [
    lambda r: f"<p>{STOPS * r.randint(1, 4)}</p>", lambda r: f"<p>word{r.randint(0, 99)} short line</p>", lambda r: f"<div>{'Alpha Beta Gamma ' * r.randint(1, 20)}</div>",
    lambda r: "<ul>" + "<li><a href=x>some link</a></li>" * r.randint(1, 4) + "</ul>", lambda r: "<nav>menu</nav>", lambda r: "<div class=ad>buy now</div>",
    lambda r: "<article>", lambda r: "</article>", lambda r: f"<h2>Head {r.randint(0, 9)}</h2>", lambda r: "<p></p>",
]


def plain(page):
    blocks = op.Blocks(page).found
    stops = [0.0 if bad else op.stop_share(text) for text, _, bad, _ in blocks]
    known = op.known_language(blocks, stops)
    first = [op.label(*b, s, known) for b, s in zip(blocks, stops, strict=True)]
    out = []
    for k, (text, _, _, article) in enumerate(blocks):
        good = first[k]
        if good is None:
            near = []
            for way in (-1, 1):
                j = k + way
                while 0 <= j < len(blocks) and blocks[j][3] == article and first[j] is None:
                    j += way
                if 0 <= j < len(blocks) and blocks[j][3] == article:
                    near.append((abs(j - k), not first[j]))
                elif article:
                    near.append((abs(j - k), False))  # the article's edge
            if near:
                good = not min(near)[1]
            else:
                good = all(x is None for x in first) and not any(b[3] for b in blocks)
            if not known and not any(b[3] for b in blocks) and True not in first:
                good = True
        if good:
            out.append(text)
    return " ".join(out)


def test_second_pass_equals_plain_code():
    rnd = random.Random(12)
    pages = ["".join(rnd.choice(PIECES)(rnd) for _ in range(rnd.randint(0, 25))) for _ in range(600)]
    got = [op.extract(p) for p in pages]
    assert got == [plain(p) for p in pages]
    assert len(set(got)) > 400
