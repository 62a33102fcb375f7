import pytest

from sparkdeck.functions.stems import stem, stem_tokens

# published sample pairs of the algorithm
PAIRS = """continu continu|continua continu|continuait continu|continuant continu|continuation continu|continue continu
continué continu|continuel continuel|continuelle continuel|continuellement continuel|continuelles continuel|continuels continuel
continuer continu|continuera continu|continuerait continu|continueront continu|continuez continu|continuité continu
continuons continuon|contorsions contors|contour contour|contournait contourn|contournant contourn|contre contr|contractées contract
contradictoirement contradictoir|contraindre contraindr|contraint contraint|majestueusement majestu|majestueux majestu|majeur majeur
majeure majeur|majorité major|mal mal|malade malad|malades malad|maladie malad|maladies malad|maladive malad|chevaux cheval"""


@pytest.mark.parametrize("pair", [p for line in PAIRS.splitlines() for p in line.split("|")])
def test_published_pairs(pair):
    word, want = pair.split()
    assert stem(word) == want


def test_stems_join_back(spark):
    tokens = spark.createDataFrame([(1, "majeure"), (1, "majeure"), (2, "chevaux")], "id int, word string")
    assert sorted((r.id, r.stem) for r in stem_tokens(tokens).collect()) == [(1, "majeur"), (1, "majeur"), (2, "cheval")]
