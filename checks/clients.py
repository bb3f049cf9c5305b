"""A deterministic model client for checks and dry runs."""

from collections.abc import Callable

from docgate.operators.scoring import Client


def rule_scorer() -> Callable[[], Client]:
    """``make_client`` of a deterministic client for tests and dry runs.

    The verdict follows from the page count.
    """

    def make_client():
        import json
        import re

        page_line = re.compile(r"^pages: (\d+)$", re.MULTILINE)
        tiers = ["low", "medium", "high"]
        alignments = ["aligned", "partial", "non_compliant"]

        def answer(body):
            message = json.loads(body)["messages"][0]["content"][0]["text"]
            pages = int(page_line.search(message).group(1))
            verdict = {
                "compliance_score": (pages % 100) / 100,
                "risk_tier": tiers[pages % 3],
                "policy_alignment": alignments[pages % 3],
                "reasoning": f"{pages} pages",
            }
            usage = {"input_tokens": len(message) // 4, "output_tokens": 40 + pages % 100}
            content = [{"type": "text", "text": json.dumps(verdict)}]
            return json.dumps({"content": content, "usage": usage})

        return lambda bodies: [answer(body) for body in bodies]

    return make_client


def failing_client(every: int) -> Callable[[], Client]:
    """``make_client`` of a client that raises for chunks with a record whose number ``every`` divides."""

    def make_client():
        import re

        answer = rule_scorer()()

        def client(bodies):
            for body in bodies:
                if int(re.search(r"record_id: [0-9a-f-]{24}([0-9]{12})", body).group(1)) % every == 0:
                    raise RuntimeError("no answer")
            return answer(bodies)

        return client

    return make_client
