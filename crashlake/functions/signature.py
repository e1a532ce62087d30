"""Crash signatures from stack frames and Java traces, in native array expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from crashlake.functions.text import let, strip

# Frames left out of a signature (matched from the start of the frame).
IRRELEVANT_FRAMES = (
    r"@0x[0-9a-fA-F]{2,}",
    r"@0x[1-9a-fA-F]",
    r"RaiseException",
    r"_CxxThrowException",
    r"KiFastSystemCallRet",
    r"(Nt|Zw)WaitForSingleObject(Ex)?",
    r"(Nt|Zw)WaitForMultipleObjects(Ex)?",
    r"WaitForSingleObjectExImplementation",
    r"WaitForMultipleObjectsExImplementation",
    r"___TERMINATING_DUE_TO_UNCAUGHT_EXCEPTION___",
    r"_NSRaiseError",
    r"linux-gate\.so@0x.*",
    r"libdvm\.so\s*@\s*0x.*",
    r"dalvik-LinearAlloc\s*@0x.*",
    r"dalvik-heap",
    r"libc\.so@.*",
    r"libEGL\.so@.*",
    r"libc-2\.5\.so@.*",
    r"RtlpAdjustHeapLookasideDepth",
    r"libicudata.so@.*",
    r"_ZdlPv",
)

# Frames that are joined with the frame below them.
PREFIX_FRAMES = (
    r"@0x0", r"strchr", r"strstr", r"strlen", r"PL_strlen", r"strcmp", r"strcpy", r"strncpy",
    r".*strdup", r"wcslen", r"memcpy", r"memmove", r"memcmp", r"memset", r".*calloc", r"malloc",
    r"realloc", r".*free", r"arena_dalloc_small", r"arena_alloc", r"arena_dalloc",
    r"libobjc.A.dylib@0x1568.", r"objc_msgSend", r"_purecall", r"PL_DHashTableOperate",
    r"EtwEventEnabled", r"RtlpFreeHandleForAtom", r"RtlpDeCommitFreeBlock",
    r"RtlpAllocateAffinityIndex", r"RtlAddAccessAllowedAce", r"RtlQueryPerformanceFrequency",
    r"RtlpWaitOnCriticalSection", r"RtlpWaitForCriticalSection",
    r"_PR_MD_ATOMIC_(INC|DEC)REMENT", r"operator new\([^,\)]+\)", r"CFRelease",
    r"objc_exception_throw", r"[-+]\[NSException raise(:format:(arguments:)?)?\]",
    r"WaitForSingleObject(Ex)?", r"WaitForMultipleObjects(Ex)?", r"NtUserWaitMessage",
    r"NtUserMessageCall", r"PR_AtomicIncrement", r"PR_AtomicDecrement",
    r"__libc_android_abort", r"RtlDeleteCriticalSection", r"PR_DestroyLock", r".*abort",
    r"__swrite", r"dvmAbort", r"JNI_CreateJavaVM", r"dvmStringLen", r"_VEC_memzero",
    r"arena_malloc_small", r"arena_ralloc", r"arena_run_reg_alloc", r"arena_run_tree_insert",
    r"ialloc", r"isalloc", r"arena_malloc", r"arena_run_reg_dalloc", r"arena_run_dalloc",
    r"je_malloc", r"je_realloc", r"_JNIEnv::CallObjectMethod", r"kill", r"raise",
    r"sigprocmask", r"sigblock", r"setjmp", r"fastcopy_I", r"_RTC_Terminate", r"fastzero_I",
    r"VEC_memcpy", r"_chkstk", r"_alloca_probe.*",
)


@dataclass(frozen=True)
class SignatureRules:
    """Frame patterns of a site. Vendor-specific patterns are added here by the user.

    ``sentinels`` holds frame texts, or (frame, other frame) pairs: the first counts only
    when the other frame is in the stack too.
    """

    irrelevant: tuple[str, ...] = IRRELEVANT_FRAMES
    prefix: tuple[str, ...] = PREFIX_FRAMES
    with_line_number: tuple[str, ...] = ("js_Interpret",)
    sentinels: tuple = ("_purecall",)
    max_length: int = 255
    double_quotes: bool = True


DEFAULT_RULES = SignatureRules()


def _starts(patterns: tuple[str, ...]) -> str:
    return "^(?:" + "|".join(patterns) + ")"


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def normalize_frame(module: Column, function: Column, source: Column, line: Column,
                    address: Column, rules: SignatureRules = DEFAULT_RULES) -> Column:
    """One text per frame: function, else ``file#line``, else ``module@address``."""
    name = F.when(function.rlike(_starts(rules.with_line_number)),
                  F.concat(function, F.lit(":"), F.coalesce(line, F.lit("None")))) \
        .otherwise(function)
    name = F.regexp_replace(name, r" (?=[*&,])", "")
    name = F.regexp_replace(name, r",(?! )", ", ")
    name = F.regexp_replace(name, r"(<|, )(\d+)([uUlL]?)([^\w])", "$1int$4")
    path = F.rtrim(source, F.lit("/\\"))
    file = F.when(path.contains("\\"), F.substring_index(path, "\\", -1)) \
        .otherwise(F.substring_index(path, "/", -1))
    return (F.when(~_blank(function), name)
            .when(~_blank(source) & ~_blank(line), F.concat(file, F.lit("#"), line))
            .otherwise(F.concat(F.coalesce(module, F.lit("")), F.lit("@"),
                                F.coalesce(address, F.lit("None")))))


def _finish(text: Column, rules: SignatureRules) -> Column:
    """Length cut first, then quote doubling."""
    cut = F.when(F.length(text) > rules.max_length,
                 F.concat(F.substring(text, 1, rules.max_length - 3), F.lit("..."))).otherwise(text)
    return F.replace(cut, F.lit("'"), F.lit("''")) if rules.double_quotes else cut


def from_sentinel(frames: Column, rules: SignatureRules) -> Column:
    """The stack from its first sentinel on; the whole stack when there is none."""
    found = []
    for item in rules.sentinels:
        frame, other = item if isinstance(item, tuple) else (item, None)
        at = F.nullif(F.array_position(frames, F.lit(frame)), F.lit(0))
        found.append(at if other is None else F.when(F.array_contains(frames, other), at))
    if not found:
        return frames
    return let(F.array_min(F.array_compact(F.array(*found))), lambda first: F.when(
        first.isNotNull(), F.slice(frames, first.cast("int"), F.greatest(F.size(frames), F.lit(1))))
        .otherwise(frames))


def c_signature(frames: Column, hang_type: Column, thread: Column,
                rules: SignatureRules = DEFAULT_RULES) -> Column:
    """Struct(signature, notes) of a list of normalized frames.

    Irrelevant frames are skipped; frames are joined down to the first one that is not a
    prefix frame. Hang type -1 and 1 put ``hang`` or ``chromehang`` in front.
    """
    prefix = F.when(hang_type == -1, F.lit("hang")).when(hang_type == 1, F.lit("chromehang"))

    def joined(relevant: Column) -> Column:
        ends = F.transform(relevant, lambda f: ~f.rlike(_starts(rules.prefix)))
        kept = let(F.array_position(ends, F.lit(True)).cast("int"), lambda stop: F.when(
            stop > 0, F.slice(relevant, 1, F.greatest(stop, F.lit(1)))).otherwise(relevant))
        return F.array_join(F.array_compact(F.concat(F.array(prefix), kept)), " | ")

    def named(stack: Column, text: Column) -> Column:
        empty = text == ""
        full = (F.when(~empty, text)
                .when(thread.isNull(), F.lit("EMPTY: no crashing thread identified"))
                .otherwise(F.coalesce(F.get(stack, 0), F.lit("EMPTY: no frame data available"))))
        why = F.when(thread.isNull(), F.lit("no signature: the crashing thread is unknown")) \
            .otherwise(F.concat(F.lit("no signature: no usable frames in thread "),
                                thread.cast("string")))
        return let(full, lambda t: F.struct(
            _finish(t, rules).alias("signature"),
            F.array_compact(F.array(F.when(empty, why), _cut_note(t, rules))).alias("notes")))

    stack = from_sentinel(F.coalesce(frames, F.array().cast("array<string>")), rules)
    return let(stack, lambda st: let(
        let(F.filter(st, lambda f: ~f.rlike(_starts(rules.irrelevant))), joined),
        lambda text: named(st, text)))


def _cut_note(text: Column, rules: SignatureRules) -> Column:
    return F.when(F.length(text) > rules.max_length, F.lit("signature truncated due to length"))


def java_signature(trace: Column, rules: SignatureRules = DEFAULT_RULES) -> Column:
    """Struct(signature, notes): exception class, description, method without line number."""
    body = F.regexp_replace(trace, r"(\r\n|\n|\r)$", "")
    lines = F.transform(F.slice(F.split(body, r"\r\n|\n|\r"), 1, 2), strip)

    def made(two_lines: Column, words: Column) -> Column:
        first, second = F.get(two_lines, 0), F.get(two_lines, 1)
        two = F.size(words) == 2
        name = F.concat(F.when(two, strip(F.get(words, 0))).otherwise(first), F.lit(":"))
        about = F.when(two, strip(F.get(words, 1))).otherwise(F.lit(""))
        method = F.coalesce(F.regexp_replace(second, r"\.java:\d+\)$", ".java)"), F.lit(""))
        full = F.array_join(F.filter(F.array(name, about, method), lambda s: s != ""), " ")
        long = F.length(full) > rules.max_length
        text = F.when(long, F.concat(name, F.lit(" "), method)).otherwise(full)
        return let(text, lambda t: F.struct(
            _finish(t, rules).alias("signature"), F.array_compact(F.array(
                F.when(~two, F.lit("stack trace line 1 is not in the expected format")),
                F.when(second.isNull(), F.lit("stack trace line 2 is missing")),
                F.when(second == "", F.lit("stack trace line 2 is empty")),
                F.when(long, F.lit("dropped exception description due to length")),
                _cut_note(t, rules))).alias("notes")))

    none = F.struct(F.lit("EMPTY: Java stack trace not in expected format").alias("signature"),
                    F.array(F.lit("stack trace not in expected format")).alias("notes"))
    return F.when(trace.isNull(), none).otherwise(
        let(lines, lambda ls: let(F.split(F.get(ls, 0), ":"), lambda ws: made(ls, ws))))


def signature(trace: Column, frames: Column, hang_type: Column, thread: Column,
              rules: SignatureRules = DEFAULT_RULES) -> Column:
    """Java signature where a Java trace was sent, frame signature otherwise."""
    return F.when(~_blank(trace), java_signature(trace, rules)) \
        .otherwise(c_signature(frames, hang_type, thread, rules))
