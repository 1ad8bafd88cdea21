"""Where codecs run: resource profiles for the tasks that encode and decode, and a codec for each device and worker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

_made: dict[tuple, object] = {}


def accelerated(spark: SparkSession, amount: float = 1.0, resource: str = "gpu", cores: int | None = None, memory: str | None = None, script: str = "", force: bool = False):
    """A profile of tasks that each hold so much of a resource, to be handed to mapInArrow; None where the master gives out none.

    With executor cores or memory, executors of that shape are asked for, which needs dynamic allocation; else the tasks run on those that
    are there. Local masters have no profiles, and the work runs plainly; force gives one all the same, to look at a plan.
    """
    from pyspark.resource import ExecutorResourceRequests, ResourceProfileBuilder, TaskResourceRequests

    if spark.sparkContext.master.startswith("local") and not force:
        return None
    builder = ResourceProfileBuilder().require(TaskResourceRequests().cpus(1).resource(resource, amount))
    if cores or memory:
        wanted = ExecutorResourceRequests().resource(resource, max(1, int(amount)), script)
        wanted = wanted.cores(cores) if cores else wanted
        builder = builder.require(wanted.memory(memory) if memory else wanted)
    return builder.build


def device(resource: str = "gpu") -> str:
    """The address of the device that this task holds; cpu without one."""
    from pyspark import TaskContext

    context = TaskContext.get()
    held = context.resources().get(resource) if context else None
    return f"{resource}:{held.addresses[0]}" if held and held.addresses else "cpu"


def on_device(name: str, make: Callable[[str], object], resource: str = "gpu") -> Callable[[], object]:
    """What encode and decode take as their codec: make(device) once a worker and device, whatever the number of its tasks."""

    def codec():
        key = name, device(resource)
        if key not in _made:
            _made[key] = make(key[1])
        return _made[key]

    return codec
