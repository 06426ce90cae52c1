"""Language query; code lengths are beyond SQL, tests compare with a plain coder."""

from __future__ import annotations

from voltide.llm.catalog import query
from voltide.llm.common import table
from voltide.llm.ppm_language import predict_languages


@query("op11_ppm_language")
def ppm_language(spark, sf):
    return predict_languages(table(spark, sf, "documents"))
