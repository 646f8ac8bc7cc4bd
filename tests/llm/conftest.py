import pytest


@pytest.fixture(autouse=True)
def key_of_the_tests(request):
    """Pseudonyms have no key of their own; the tests of the text operators bring one."""
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.set("spark.riskloom.pseudonyms.key", "a key for tests")
