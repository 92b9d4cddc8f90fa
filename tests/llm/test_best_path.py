"""The best path of a word, and the work it takes."""

from retailmart.llm.queries import vocabulary_file
from retailmart.llm.segment import BLANK, Vocabulary


def test_known_words_spell_nothing(monkeypatch):
    vocabulary = Vocabulary(vocabulary_file())
    spelled = []
    spell = Vocabulary._spell
    monkeypatch.setattr(Vocabulary, "_spell", lambda self, *given: (spelled.append(given[0]), spell(self, *given)))
    words = [f"{BLANK}{w}" for w in ("documents", "x", "unbelievable", "2021", "a-b")]
    odd = [f"{BLANK}a\U0001f984b", "\U0001f984", f"b\U0001f984\U0001f984"]
    for word in (*words, *odd):
        (first, ids), *rest = vocabulary.paths(word, 2)
        score, best, loss = vocabulary.best(word)
        assert score == first and vocabulary.raw(best) == vocabulary.raw(ids) == word.replace(BLANK, " ").encode()
        assert not rest or loss == first - rest[0][0]
    assert spelled == odd
