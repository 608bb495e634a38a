import pytest

from tickloom.llm import store


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """The session has no shared folder, so tests set one of their own."""
    with pytest.MonkeyPatch.context() as patch:
        folder = str(tmp_path_factory.mktemp("shared"))
        patch.setattr(store, "shared_root", lambda _: folder)
        store.ready(spark)
        yield folder
