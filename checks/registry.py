"""All checks by key."""

from checks import descriptive, features, given, learning, prepare, ranking, search, sources, taste

CHECKS = {
    **descriptive.CHECKS, **prepare.CHECKS, **sources.CHECKS, **features.CHECKS, **ranking.CHECKS, **search.CHECKS,
    **taste.CHECKS, **learning.CHECKS, **given.CHECKS,
}
