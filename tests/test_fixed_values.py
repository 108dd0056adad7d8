"""The fixed values written out, since the SQL takes them from the library."""

from clicklens.functions.genre import GENRE_RULES
from clicklens.schema import EXPLORE_FACTORS, FACTORS, HIGHLIGHTS, KPI_LABELS


def test_genres():
    texts = {text: broad for broad, texts in GENRE_RULES for text in texts}
    assert texts == {
        "Current Affairs": "News",
        "News": "News",
        "Politic": "News",
        "Prime Ministerial": "News",
        "Children": "Children's",
        "Drama": "Drama",
        "Light Ent": "Entertainment",
        "Outside Broadcast": "Entertainment",
        "Opt Outs": "Entertainment",
        "Features / Factual": "Factual",
        "General Programmes": "Factual",
        "Education": "Learning",
        "Schools": "Learning",
        "Language": "Learning",
        "Music": "Music",
        "Dance": "Music",
        "Religio": "Religion & Ethics",
        "Sport": "Sport",
        "Comedy": "Comedy",
        "Sitcom": "Comedy",
        "Sit Com": "Comedy",
    }
    assert [broad for broad, _ in GENRE_RULES] == [
        "News", "Children's", "Drama", "Entertainment", "Factual", "Learning",
        "Music", "Religion & Ethics", "Sport", "Comedy",
    ]


def test_factors_and_charts():
    assert [(f.label, f.column, f.chart) for f in FACTORS] == [
        ("entry", "entry_type", "how"),
        ("hour", "hour", "when"),
        ("region", "region", "who"),
        ("platform", "platform", "how"),
        ("application", "application_type", "how"),
    ]
    assert [f.label for f in EXPLORE_FACTORS] == [
        "entry", "hour", "product", "region", "platform", "application",
    ]


def test_labels():
    assert KPI_LABELS == {
        "reach": "Reach: total unique browsers",
        "use": "Use: total time spent",
        "breadth": "Breadth: average amount of products visited",
    }
    assert HIGHLIGHTS == (("who", "Who", "A"), ("how", "How", "B"), ("when", "When", "C"))
