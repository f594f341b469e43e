"""The service's answers over HTTP, with the standard library's server."""

from __future__ import annotations

import json
import threading
from datetime import date
from decimal import Decimal
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, unquote, urlsplit

from .status import Service


def to_json(body: object) -> str:
    """Times in ISO form, decimals as numbers."""
    return json.dumps(body, default=lambda x: x.isoformat() if isinstance(x, date) else int(x) if isinstance(x, Decimal) else str(x))


def respond(service: Service, target: str, now_ms: int = 0) -> tuple[int, str, str]:
    """Status code, content type and text of a GET."""
    url = urlsplit(target)
    parts, asked = [unquote(p) for p in url.path.strip("/").split("/")], {k: v[-1] for k, v in parse_qs(url.query).items()}
    if url.path == "/healthz":
        code, body = service.health()
        return code, "text/plain", str(body)
    if url.path == "/metrics":
        code, body = service.render_metrics()
        return code, "text/plain; version=0.0.4", str(body)
    try:
        limit = int(asked["limit"]) if "limit" in asked else None
    except ValueError:
        return 400, "application/json", to_json({"error": "limit must be a whole number"})
    if url.path == "/readyz":
        code, body = service.ready()
    elif url.path == "/status":
        code, body = service.status(now_ms)
    elif url.path == "/v1/events/recent":
        code, body = service.recent_events(asked.get("event_type"), limit)
    elif url.path == "/v1/swaps/recent":
        code, body = service.recent_swaps(asked.get("program_id"), limit)
    elif len(parts) == 4 and parts[:2] == ["v1", "streams"] and parts[3] == "lag":
        code, body = service.stream_lag(parts[2])
    else:
        code, body = 404, {"error": "not found"}
    return code, "application/json", to_json(body)


def start(service: Service, address: str, clock) -> ThreadingHTTPServer:
    """Serve in the background until ``shutdown()``."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            code, kind, text = respond(service, self.path, clock())
            data = text.encode()
            self.send_response(code)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_) -> None:
            pass

    host, _, port = address.rpartition(":")
    server = ThreadingHTTPServer((host, int(port)), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
