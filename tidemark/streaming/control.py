"""The control endpoint: state commands over the Redis protocol."""

from __future__ import annotations

import socketserver
import threading

from tidemark.streaming.apply import State


def reply(value: str | int | None) -> bytes:
    if value is None:
        return b"$-1\r\n"
    if isinstance(value, int):
        return f":{value}\r\n".encode()
    if value in ("OK", "PONG"):
        return f"+{value}\r\n".encode()
    data = value.encode()
    return b"$%d\r\n%s\r\n" % (len(data), data)


def read_command(stream: object) -> list[str] | None:
    """An array of bulk strings, or a line of words; None at the end of the stream."""
    line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"*"):
        return line.decode().split()
    words = []
    for _ in range(int(line[1:])):
        size = int(stream.readline()[1:])
        words.append(stream.read(size + 2)[:-2].decode())
    return words


class _Handler(socketserver.StreamRequestHandler):
    def handle(self) -> None:
        while (words := read_command(self.rfile)) is not None:
            if not words:
                continue
            try:
                with self.server.lock:
                    out = reply(self.server.state.command(*words))
            except ValueError as e:
                out = f"-ERR {e}\r\n".encode()
            self.wfile.write(out)
            if words[0].lower() == "quit":
                return


class Control(socketserver.ThreadingTCPServer):
    """Serves ``state`` at host:port until close()."""

    allow_reuse_address, daemon_threads = True, True

    def __init__(self, state: State, bind: str) -> None:
        host, _, port = bind.rpartition(":")
        super().__init__((host or "127.0.0.1", int(port)), _Handler)
        self.state, self.lock = state, threading.Lock()
        threading.Thread(target=self.serve_forever, daemon=True).start()

    def close(self) -> None:
        self.shutdown()
        self.server_close()
