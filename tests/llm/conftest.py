from conftest_llm import no_docs, odd, odd_docs, small  # noqa: F401
