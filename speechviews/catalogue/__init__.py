"""Named queries over the supplied tables, each with equivalent SQL where SQL can say it."""

from speechviews.catalogue import (  # noqa: F401  (importing registers the queries)
    features, live, messages, model, preparation, uploads, view, words,
)
from speechviews.catalogue.registry import ORACLES, QUERIES  # noqa: F401
