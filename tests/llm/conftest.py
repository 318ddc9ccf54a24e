import pytest

from feedlake.llm.queries import workers_find_package


@pytest.fixture(autouse=True)
def ready(request):
    if "spark" in request.fixturenames:
        workers_find_package(request.getfixturevalue("spark"))
