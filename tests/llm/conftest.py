from tests.conftest import spark  # noqa: F401
