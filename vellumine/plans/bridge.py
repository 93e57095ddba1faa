"""Line protocols with a child process: one request and one answer a line, or JSON-RPC with notifications.

A client belongs to one process: a task on an executor makes its own.  Nothing
here opens a network connection; the child may.
"""

from __future__ import annotations

import atexit
import base64
import json
import os
import queue
import re
import subprocess
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from pathlib import Path


class BridgeError(RuntimeError):
    """The child broke the protocol, failed a request or ended."""


class _Child:
    """A process whose lines arrive in a queue; None says that it ended."""

    def __init__(self, command: list[str], environment: Mapping[str, str] | None = None):
        try:
            self.process = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, encoding="utf-8", errors="replace", bufsize=1, env=environment)
        except OSError as e:
            raise BridgeError(f"could not start {command[0]}: {e}") from e
        self.lines: queue.Queue[str | None] = queue.Queue()
        self.said: deque[str] = deque(maxlen=200)
        for target in (self._read, self._listen):
            threading.Thread(target=target, daemon=True).start()

    def _read(self) -> None:
        for line in self.process.stdout:
            if line.strip():
                self.lines.put(line)
        self.lines.put(None)

    def _listen(self) -> None:
        self.said.extend(line.rstrip() for line in self.process.stderr if line.strip())

    @property
    def alive(self) -> bool:
        return self.process.poll() is None

    def send(self, value: dict) -> None:
        try:
            self.process.stdin.write(json.dumps(value, ensure_ascii=False) + "\n")
            self.process.stdin.flush()
        except OSError as e:
            raise BridgeError(f"the helper stopped before the request (exit={self.process.poll()})") from e

    def next(self, seconds: float) -> dict:
        try:
            line = self.lines.get(timeout=max(0.0, seconds))
        except queue.Empty:
            raise TimeoutError(f"no answer within {seconds:g} s") from None
        if line is None:
            raise BridgeError(f"the helper ended: {' '.join(self.said) or 'nothing said'}")
        try:
            value = json.loads(line)
        except ValueError as e:
            raise BridgeError(f"not JSON: {line[:500]}") from e
        if not isinstance(value, dict):
            raise BridgeError(f"not an object: {line[:500]}")
        return value

    def close(self, seconds: float = 5) -> None:
        try:
            self.process.stdin.close()
        except OSError:
            pass
        for end in (lambda: None, self.process.terminate, self.process.kill):
            end()
            try:
                self.process.wait(timeout=seconds)
                return
            except subprocess.TimeoutExpired:
                continue


class LineBridge:
    """Requests one at a time, whatever thread asks; the child starts with the first one and again after it ended."""

    def __init__(self, command: list[str], seconds: float = 360):
        self.command, self.seconds = command, seconds
        self.child: _Child | None = None
        self.number = 0
        self.lock = threading.Lock()

    def request(self, payload: dict) -> dict:
        with self.lock:
            if self.child is None or not self.child.alive:
                self.child = _Child(self.command)
            self.number += 1
            self.child.send(payload | {"id": self.number})
            try:
                answer = self.child.next(self.seconds)
            except TimeoutError:
                self.close()
                raise
        if answer.get("id") != self.number:
            raise BridgeError(f"answer to another request: {answer.get('id')}")
        if not answer.get("ok"):
            raise BridgeError(answer.get("error") or "the request failed")
        if not isinstance(answer.get("result"), dict):
            raise BridgeError("the result is no object")
        return answer["result"]

    def close(self) -> None:
        child, self.child = self.child, None
        if child:
            child.close()


_bridges: dict[tuple[str, ...], LineBridge] = {}
_lock = threading.Lock()


def bridge(command: Iterable[str]) -> LineBridge:
    """The process's own bridge to a command."""
    with _lock:
        return _bridges.setdefault(tuple(command), LineBridge(list(command)))


@atexit.register
def close_bridges() -> None:
    with _lock:
        found = list(_bridges.values())
        _bridges.clear()
    for one in found:
        one.close()


def served(lines: Iterable[str], actions: Mapping[str, Callable[[dict], dict]]) -> Iterator[str]:
    """The other side: an answer line for each request line; a failed one is answered with its error."""
    for line in lines:
        if not line.strip():
            continue
        number = None
        try:
            request = json.loads(line)
            if not isinstance(request, dict):
                raise ValueError("the request must be an object")
            number = request.get("id")
            action = actions.get(request.get("action"))
            if action is None:
                raise ValueError(f"unknown action: {request.get('action')}")
            yield json.dumps({"id": number, "ok": True, "result": action(request)}, ensure_ascii=False)
        except Exception as e:  # noqa: BLE001  the loop goes on
            yield json.dumps({"id": number, "ok": False, "error": f"{type(e).__name__}: {e}"}, ensure_ascii=False)


def translate_request(request: dict) -> dict:
    """A translation request with its needed texts."""
    for name in ("text", "target_lang"):
        if not isinstance(request.get(name), str) or not request[name].strip():
            raise ValueError(f"translate needs {name}")
    return request


def encoded_credentials(data: dict) -> str:
    return base64.urlsafe_b64encode(json.dumps(data, ensure_ascii=False, separators=(",", ":")).encode()).rstrip(b"=").decode()


def decoded_credentials(value: str) -> dict:
    data = json.loads(base64.urlsafe_b64decode(value + "=" * (-len(value) % 4)))
    if not isinstance(data, dict):
        raise ValueError("credentials must be an object")
    return data


def store_credential(path: Path, name: str, value: str) -> None:
    """Set one name of an environment file; its other lines and line ends stay, repeats of the name go, only the owner may read it."""
    source = path.read_bytes().decode() if path.exists() else ""
    end = "\r\n" if "\r\n" in source else "\n"
    own = re.compile(rf"\s*(?:export\s+)?{re.escape(name)}\s*=")
    lines = [x for x in re.sub(r"\r?\n\Z", "", source).split(end)] if source else []
    first = next((k for k, x in enumerate(lines) if own.match(x)), len(lines))
    kept = [x for x in lines[:first]] + [f"{name}={value}"] + [x for x in lines[first + 1 :] if not own.match(x)]
    part = path.with_name(f"{path.name}.{os.getpid()}.part")
    part.touch(mode=0o600)
    part.write_bytes((end.join(kept) + end).encode())
    os.replace(part, path)


@dataclass(frozen=True)
class Turn:
    """One answered turn of a reviewer's thread."""

    thread_id: str
    turn_id: str
    response: dict
    usage: dict
    elapsed_seconds: float


class RpcClient:
    """JSON-RPC over a child's lines: requests with deadlines, notifications kept in order, the child's own requests refused."""

    def __init__(self, command: list[str], seconds: float, environment: Mapping[str, str] | None = None, about: dict | None = None):
        self.command, self.seconds, self.environment = command, seconds, environment
        self.about = about or {"name": "reviewer", "title": "Reviewer", "version": "1"}
        self.number = 0
        self.waiting: deque[dict] = deque()

    def __enter__(self) -> RpcClient:
        self.child = _Child(self.command, self.environment)
        self.request("initialize", {"clientInfo": self.about, "capabilities": {"experimentalApi": True}}, 30)
        self.child.send({"method": "initialized", "params": {}})
        return self

    def __exit__(self, *_: object) -> None:
        self.child.close()

    def _event(self, deadline: float) -> dict | None:
        """The next answer or notification; a request of the child is refused and skipped."""
        event = self.child.next(deadline - time.monotonic())
        if "method" in event and "id" in event:
            self.child.send({"id": event["id"], "error": {"code": -32601, "message": "this client takes no requests"}})
            return None
        return event

    def request(self, method: str, params: dict, seconds: float | None = None) -> dict:
        self.number += 1
        number, deadline = self.number, time.monotonic() + (seconds or self.seconds)
        self.child.send({"method": method, "id": number, "params": params})
        while True:
            event = self._event(deadline)
            if event is None:
                continue
            if event.get("id") != number:
                if "method" in event:
                    self.waiting.append(event)
                continue
            if "error" in event:
                raise BridgeError(f"{method} failed: {json.dumps(event['error'], ensure_ascii=False)}")
            if not isinstance(event.get("result"), dict):
                raise BridgeError(f"{method} gave no object")
            return event["result"]

    def thread(self, params: dict, resume: str | None = None) -> str:
        """A new thread, or an old one again, which must be the same."""
        result = self.request("thread/resume", {"threadId": resume}) if resume else self.request("thread/start", params)
        found = (result.get("thread") or {}).get("id")
        if not isinstance(found, str) or (resume and found != resume):
            raise BridgeError("wrong thread, or none")
        return found

    def turn(self, thread_id: str, items: list[dict], schema: dict, effort: str) -> Turn:
        """Ask and wait: the last message of the turn is its answer, the last count its usage."""
        began = time.monotonic()
        asked = {"threadId": thread_id, "input": items, "outputSchema": schema, "effort": effort, "sandboxPolicy": {"type": "readOnly", "networkAccess": False}, "approvalPolicy": "never"}
        own = (self.request("turn/start", asked).get("turn") or {}).get("id")
        if not isinstance(own, str):
            raise BridgeError("turn/start gave no turn")
        text, usage, deadline = None, None, began + self.seconds
        while True:
            event = self.waiting.popleft() if self.waiting else self._event(deadline)
            params = (event or {}).get("params")
            if not isinstance(params, dict):
                continue
            method, turn = event["method"], params.get("turn") if isinstance(params.get("turn"), dict) else {}
            if (turn.get("id") if method == "turn/completed" else params.get("turnId")) != own:
                continue
            item = params.get("item") or {}
            if method == "item/completed" and item.get("type") == "agentMessage" and isinstance(item.get("text"), str):
                text = item["text"]
            elif method == "thread/tokenUsage/updated":
                usage = (params.get("tokenUsage") or {}).get("last") or usage
            elif method == "turn/completed":
                if turn.get("status") != "completed":
                    raise BridgeError(f"the turn did not complete: {json.dumps(turn.get('error'), ensure_ascii=False)}")
                break
        try:
            response = json.loads(text if text is not None else "")
        except ValueError as e:
            raise BridgeError("the turn gave no JSON answer") from e
        if not isinstance(response, dict):
            raise BridgeError("the answer must be an object")
        return Turn(thread_id, own, response, usage or {"available": False, "reason": "no usage was told"}, time.monotonic() - began)
