"""Protobuf messages by the descriptors that a recording carries."""

from __future__ import annotations

from functools import lru_cache

from google.protobuf import descriptor_pb2, descriptor_pool, duration_pb2, message, message_factory, timestamp_pb2

#: Files that descriptor sets may leave out.
KNOWN = {m.DESCRIPTOR.name: m.DESCRIPTOR.serialized_pb for m in (duration_pb2, timestamp_pb2)}


@lru_cache(maxsize=64)
def message_class(name: str, descriptors: bytes) -> type[message.Message]:
    """The class of a full message name, by a serialized FileDescriptorSet; its files may come in any order."""
    try:
        files = {f.name: f for f in descriptor_pb2.FileDescriptorSet.FromString(descriptors).file}
    except message.DecodeError as e:
        raise ValueError(f"the schema of {name} is no descriptor set: {e}") from e
    pool, added = descriptor_pool.DescriptorPool(), set()

    def add(file: str) -> None:
        if file in added:
            return
        added.add(file)
        if file not in files and file not in KNOWN:
            raise ValueError(f"the schema of {name} lacks {file}")
        proto = files.get(file) or descriptor_pb2.FileDescriptorProto.FromString(KNOWN[file])
        for other in proto.dependency:
            add(other)
        pool.Add(proto)

    for file in files:
        add(file)
    try:
        return message_factory.GetMessageClass(pool.FindMessageTypeByName(name))
    except (KeyError, TypeError) as e:
        raise ValueError(f"the schema of {name} is not usable: {e}") from e


def parsed(data: bytes, name: str, descriptors: bytes) -> message.Message:
    try:
        return message_class(name, descriptors).FromString(data)
    except message.DecodeError as e:
        raise ValueError(f"a message is no {name}: {e}") from e


def vector(m: message.Message, field: str) -> list[float] | None:
    """The numbers of a field, one or repeated; None if the message type has no such field."""
    if field not in m.DESCRIPTOR.fields_by_name:
        return None
    value = getattr(m, field)
    return [float(value)] if isinstance(value, int | float) else [float(x) for x in value]


def frame(m: message.Message, data: str, format: str) -> tuple[bytes, str]:
    """Bytes and codec of a camera message."""
    if lacking := [f for f in (data, format) if f not in m.DESCRIPTOR.fields_by_name]:
        raise ValueError(f"{m.DESCRIPTOR.full_name} has no field {lacking[0]!r}")
    return getattr(m, data), getattr(m, format)
