import pytest

from visitlens.params import TaskParams, sampling_ratio


@pytest.mark.parametrize("value, ratio", [
    (None, 0.01), (0, 0.01), (-1, 0.01), (0.1, 0.1), (0.2, 0.01), ("x", 0.01), ("0.05", 0.05),
    ("", 0.01), ("nan", 0.01),
])
def test_sampling_ratio(value, ratio):
    assert sampling_ratio(value) == ratio


def test_blank_is_absent():
    p = TaskParams.from_document({"startDate": " ", "sex": "", "professionals": " , ,"})
    assert (p.start_date, p.sex, p.professionals, p.needs_users) == (None, None, (), False)


def test_lists_are_trimmed():
    p = TaskParams.from_document('{"professionals": " a, b ,,c", "cities": "x"}')
    assert p.professionals == ("a", "b", "c")
    assert p.cities == ("x",)
    assert p.needs_users


@pytest.mark.parametrize("document", ["{}", {}, "null"])
def test_empty_document_is_an_error(document):
    with pytest.raises(ValueError):
        TaskParams.from_document(document)


@pytest.mark.parametrize("given, mode", [("poisson", "poisson"), ("Poisson", "bernoulli"),
                                         ("", "bernoulli"), ("other", "bernoulli")])
def test_sample_type(given, mode):
    assert TaskParams.from_document({"sampleType": given, "x": "1"}).sample_type == mode
