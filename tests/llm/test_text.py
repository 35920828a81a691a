from citeloom.llm import text as T


def diff(a, b):
    return T.title_difference(T.title_tokens(a), T.title_tokens(b))


def test_title_tokens():
    assert T.title_tokens("[Paper] Full paper: <i>On</i> the Use of A &amp; B-Cs.") == ["use", "b", "cs"]
    assert T.title_tokens(None) == [] and T.title_tokens(" ") == []
    assert T.title_tokens("Of the") == ["of", "the"]


def test_title_difference():
    assert diff("Mining sparse glyphs", "MINING SPARSE GLYPHS.") == (0, 0, 0, False)
    assert diff("Mining sparse glyphs", "Minnig sparse glyps")[:2] == (0, 0)
    assert diff("TreeKit+: mining sparse glyphs", "TreeKit: mining sparse glyphs")[:2] != (0, 0)
    assert diff("Mining sparse glyphs for genomics", "Mining sparse glyphs for gen…") == (0, 0, 0, True)
    assert diff("TreeKit: mining sparse glyphs", "Mining sparse glyphs")[3]
    for later in ("Mining sparse glyphs, Part II", "Mining sparse glyphs Revisited", "Lessons from Mining sparse glyphs", "A Second Look at Mining sparse glyphs"):
        assert sum(diff("Mining sparse glyphs", later)[:2]) > 0


def test_surnames():
    names = ["John A. Smith 0001", "Smith, John", "J. Smith", "Smith JA", "Dr. John van der Smith (Ed.)", "JOHN SMITH"]
    assert {T.surname(n)[0] for n in names} == {"smith"}
    assert T.surnames(["et al.", None, "", "Anonymous"]) == [] and T.surnames(None) == []
    assert T.names_shared(["smith|john"], ["john|smith"]) == 1
    assert T.names_shared(["smith|john", "doe|"], ["smyth|", "roe|"]) == 1


def test_osa():
    assert T.osa("abcd", "acbd", 3) == 1 and T.osa("abcd", "abcd", 0) == 0 and T.osa("abc", "xyz", 1) == 2
