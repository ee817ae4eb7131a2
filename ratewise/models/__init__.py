"""Recommenders fitted and applied as distributed Spark jobs.

Common contract: ``fit(train) -> model``; ``model.predict(pairs)`` adds a
``prediction`` column; ``model.recommend(users, k, seen=None)`` returns long
rows (user, item, rank, score) -- always set-at-a-time.
"""
