"""Errors a caller may want to tell apart."""


class LakeError(Exception):
    """Base of every error raised on purpose by this package."""


class SourceUnreadable(LakeError):
    """A raw path does not exist or cannot be opened."""


class NoRunFound(LakeError):
    """No run folder with a readable name lies under the raw root."""


class PageFetchError(LakeError):
    """A page could not be fetched within the allowed attempts."""


class PageBoundReached(LakeError):
    """The page bound a caller set cuts a load short; nothing was landed."""


class MissingKey(LakeError):
    """Records of a paged load carry no key; nothing was landed."""


class DuplicateSourceKey(LakeError):
    """Several source rows carry a key that the target already holds."""


class SchemaConflict(LakeError):
    """A published table cannot take the new columns."""


class SchemaCheckFailed(LakeError):
    """A table does not have the declared fields."""

    def __init__(self, problems):
        self.problems = list(problems)
        super().__init__("; ".join(f"{p['field']}: {p['problem']}" for p in self.problems))


class QualityGateError(LakeError):
    """At least one error-level constraint failed."""

    def __init__(self, failures):
        self.failures = list(failures)
        super().__init__(
            "; ".join(f"{f['constraint']}({f['column']}): {f['message']}" for f in self.failures)
        )
