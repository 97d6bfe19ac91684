from datetime import date

from sediment.functions import text


def test_clean_text_turns_blank_into_null_and_keeps_tabs(column):
    assert column(text.clean_text, ["", "   ", " a ", None, "\t"]) == [None, None, "a", None, "\t"]


def test_valid_key_edges(column):
    values = ["", " 7 ", "ID Prédio", "12\n", "99999999999", None, "-3", "1.0"]
    assert column(text.valid_key, values) == [False, True, False, False, True, False, False, False]


def test_safe_key_overflow_is_null(column):
    assert column(text.safe_key, [" 7 ", "99999999999", "x"]) == [7, None, None]
    assert column(lambda c: text.safe_key(c, "bigint"), ["99999999999"]) == [99999999999]


def test_safe_int_rounds_and_never_fails(column):
    assert column(text.safe_int, ["5", "1.5", "2.5", "-2.5", "1e3", "abc", "", None, "99999999999"]) == [
        5, 2, 3, -3, 1000, None, None, None, None,
    ]


def test_safe_date_rejects_partial_dates(column):
    values = ["2026-08-17", "2026", "2026-08", "2026-13-01", "17/08/2026", None]
    assert column(text.safe_date, values) == [date(2026, 8, 17), None, None, None, None, None]


def test_classify_like_first_match_wins_and_null_gets_default(column):
    rules = [("PRÓPRIO%", "OWN"), ("%PRÓPRIO%", "MIXED")]
    values = ["Próprio / x", "não próprio", "outro", None]
    assert column(lambda c: text.classify_like(c, rules, "NONE"), values) == ["OWN", "MIXED", "NONE", "NONE"]


def test_map_domain_trims_and_ignores_case(column):
    domain = {"próprio": "OWN", "cedido": "LENT"}
    values = [" PRÓPRIO ", "cedido", "Alugado", "", None]
    assert column(lambda c: text.map_domain(c, domain, "NONE"), values) == ["OWN", "LENT", "NONE", "NONE", "NONE"]


def test_conform_merges_spellings(column):
    assert len(set(column(text.conform, ["Fátima do sul", "Fátima do Sul"]))) == 1
