import pytest

from loomwick.llm import html_extraction as op

PARAGRAPHS = {
    "ru": "Вчера вечером жители небольшого города собрались на площади и долго обсуждали новый мост через реку, который строили почти десять лет. " * 2,
    "pl": "Wczoraj wieczorem mieszkańcy niewielkiego miasta zebrali się przy rynku, żeby omówić budowę nowego mostu, trwającą prawie dziesięć lat. " * 2,
    "zh": "昨天晚上小城的居民聚集在广场上讨论修建了将近十年的新桥" * 8,
    "zh short": "昨天晚上小城的居民聚集在广场上讨论新桥",
}


@pytest.mark.parametrize("name", PARAGRAPHS)
def test_pages_without_article_in_other_languages(name):
    text = PARAGRAPHS[name].strip()
    page = f"<body><nav><a href=x>menu</a></nav><div><h1>Abc</h1><p>{text}</p><p>{text}</p></div><footer>foot</footer></body>"
    got = op.extract(page)
    assert got.count(text) == 2 and "menu" not in got and "foot" not in got


def test_long_link_lists_and_listed_languages_stay_as_they_were():
    links = "".join(f"<a href=x>Городские новости {k}</a> " for k in range(30))
    assert "новости" not in op.extract(f"<body><p>{PARAGRAPHS['ru']}</p><div>{links}</div></body>")
    english = "the cat and the dog were in the house with a bird that it was of no use to them " * 3
    names = "Alpha Beta Gamma Delta Epsilon Zeta " * 7
    assert op.extract(f"<p>{english}</p><div>{names}</div><p>{english}</p>") == f"{english.strip()} {english.strip()}"
