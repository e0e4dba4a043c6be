"""State calls of the running mart: a key without input costs its batch as few round trips to the state store as can be."""

from eventmart.schemas import MART_MEASURES
from eventmart.streaming.state import RunningMart


class Handle:
    """Value state and timers of one key, counting the calls made on them."""

    def __init__(self, timers=()):
        self.calls, self.timers, self.value = [], set(timers), None

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def listTimers(self):
        self.calls.append("listTimers")
        return iter(sorted(self.timers))

    def deleteTimer(self, due):
        self.calls.append("deleteTimer")
        self.timers.discard(due)

    def registerTimer(self, due):
        self.calls.append("registerTimer")
        self.timers.add(due)


class At:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def processor(handle):
    running = RunningMart(every_key=True)
    running.init(handle)
    return running


def test_a_due_key_without_input_makes_two_state_calls():
    handle = Handle(timers=[1001])
    handle.value = tuple(range(len(MART_MEASURES)))
    rows = list(processor(handle).handleExpiredTimer(("a", "1"), At(2000), None))
    handle.timers.discard(1001)  # Spark deletes the expired timer after the handler
    assert handle.calls == ["registerTimer", "get"]
    assert handle.timers == {2001}
    assert tuple(rows[0])[2:] == handle.value


def test_a_seeded_key_makes_two_state_calls_and_input_still_replaces_a_due_timer():
    handle = Handle()
    running = processor(handle)
    seed = {m: 1 for m in MART_MEASURES}
    running.handleInitialState(("a", "1"), seed, At(2000))
    assert handle.calls == ["update", "registerTimer"] and handle.timers == {2001}
    handle.timers = {1001}
    list(running.handleInputRows(("a", "1"), iter([seed]), At(2000)))
    assert handle.timers == {2001}
    assert handle.value == tuple(2 for _ in MART_MEASURES)
