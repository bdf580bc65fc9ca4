from actionlens.sources.fixtures import actions, comments, log, products, target_products, users  # noqa: F401
