"""Sink options. Keys are the same in any letter case."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from vecsink.operators.delivery import Delivery

# Option keys.
BATCH_SIZE = "batchSize"
CLASS_NAME = "className"
VECTOR = "vector"
ID = "id"
RETRIES = "retries"
RETRIES_BACKOFF = "retriesBackoff"
TIMEOUT = "timeout"
HOST = "host"
SCHEME = "scheme"
API_KEY = "apiKey"
HEADER_PREFIX = "header:"
OIDC_USERNAME = "oidc:username"
OIDC_PASSWORD = "oidc:password"
OIDC_CLIENT_SECRET = "oidc:clientSecret"
OIDC_ACCESS_TOKEN = "oidc:accessToken"
OIDC_ACCESS_TOKEN_LIFETIME = "oidc:accessTokenLifetime"
OIDC_REFRESH_TOKEN = "oidc:refreshToken"
SCHEMA_REGISTRY_URL = "schemaRegistryUrl"
SCHEMA_REGISTRY_API_KEY = "schemaRegistryApiKey"
SCHEMA_REGISTRY_API_SECRET = "schemaRegistryApiSecret"
# Keys of this engine.
REGISTRY = "registry"
ID_MODE = "idMode"
ON_ERROR = "onError"
PATH = "path"
RUN = "run"
BATCH_ID = "batchId"
KEEP_REJECTS = "keepRejects"

_OWN = (
    BATCH_SIZE, CLASS_NAME, VECTOR, ID, RETRIES, RETRIES_BACKOFF, SCHEMA_REGISTRY_URL, SCHEMA_REGISTRY_API_KEY,
    SCHEMA_REGISTRY_API_SECRET, REGISTRY, ID_MODE, ON_ERROR, PATH, RUN, KEEP_REJECTS,
    BATCH_ID,
)


@dataclass(frozen=True)
class SinkOptions:
    class_name: str
    batch_size: int = 100
    vector: str | None = None
    id: str | None = None
    retries: int = 2
    retries_backoff: float = 2.0
    registry: str | None = None
    schema_registry_url: str | None = None
    schema_registry_api_key: str | None = None
    schema_registry_api_secret: str | None = None
    id_mode: str = "position"
    on_error: str = "fail"
    path: str | None = None
    run: str | None = None
    batch_id: int = 0
    keep_rejects: bool = False
    transport_options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, options: Mapping[str, object]) -> SinkOptions:
        """Read an option map; keys that are not ours go to the transport."""
        folded: dict[str, object] = {}
        for key, value in options.items():
            if value is not None:
                folded[key.lower()] = value

        def take(key, default=None):
            return folded.get(key.lower(), default)

        class_name = take(CLASS_NAME)
        if not class_name:
            raise ValueError(f"option {CLASS_NAME} is required")
        batch_size, retries = int(take(BATCH_SIZE, 100)), int(take(RETRIES, 2))
        if batch_size < 1:
            raise ValueError(f"option {BATCH_SIZE} must be at least 1")
        if retries < 0:
            raise ValueError(f"option {RETRIES} must not be negative")
        on_error, id_mode = str(take(ON_ERROR, "fail")), str(take(ID_MODE, "position"))
        if on_error not in ("fail", "collect"):
            raise ValueError(f"option {ON_ERROR} must be fail or collect")
        keep_rejects = str(take(KEEP_REJECTS, False)).lower() == "true"
        if (on_error == "collect" or keep_rejects) and take(PATH) is None:
            raise ValueError(f"{ON_ERROR}=collect and {KEEP_REJECTS} need {PATH}, where what is set aside is stored")
        gone = [key for key in ("rejectsPath", "failuresPath") if take(key) is not None]
        if gone:
            raise ValueError(f"{gone[0]} is no option: a batch stores what it sets aside beside its objects, see {KEEP_REJECTS}")
        own = {key.lower() for key in _OWN}
        return cls(
            class_name=str(class_name),
            batch_size=batch_size,
            vector=take(VECTOR),
            id=take(ID),
            retries=retries,
            retries_backoff=float(take(RETRIES_BACKOFF, 2)),
            registry=take(REGISTRY, take(SCHEMA_REGISTRY_URL)),
            schema_registry_url=take(SCHEMA_REGISTRY_URL),
            schema_registry_api_key=take(SCHEMA_REGISTRY_API_KEY),
            schema_registry_api_secret=take(SCHEMA_REGISTRY_API_SECRET),
            id_mode=id_mode,
            on_error=on_error,
            path=take(PATH),
            run=take(RUN),
            batch_id=int(take(BATCH_ID, 0)),
            keep_rejects=keep_rejects,
            transport_options={k: str(v) for k, v in folded.items() if k not in own},
        )

    @property
    def delivery(self) -> Delivery:
        return Delivery(self.batch_size, self.retries, self.retries_backoff)
