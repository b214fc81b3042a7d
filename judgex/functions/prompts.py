"""Prompts and training samples as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from judgex.functions.pytext import col, filled, flat, json_object, let, list_repr, strip

#: Prefixes and instructions of training samples, and their length limits in characters.
INSTRUCTION, QUESTION, ANSWER = "指令：", "问：", "答："
AMOUNT_INSTRUCTION = "你是民事借贷案件金额抽取器。给定判决文本分区（先Z4后Z3），输出最能决定审判结果的金额。只输出JSON对象，包含target_amount、amount_type、source_zone。target_amount必须是阿拉伯数字字符串。"
LAW_INSTRUCTION = "你是法律条文抽取器。请从裁判理由中抽取引用的法律与条款，仅输出JSON数组，每项包含law_name和article。"
FEE_INSTRUCTION = (
    "你是一个中国法律文书数据结构化专家。你的任务是根据给定的【原告名单】、【被告名单】及【费用段落】，提取案件受理费及其他诉讼费用的产生明细与最终分担情况。\n"
    "请严格输出标准 JSON 格式，不要包含 Markdown 标记或额外解释。输出结构需包含以下字段：\n"
    "1. total_litigation_cost (float): 案件受理费总金额。\n"
    "2. cost_details (list): 费用产生明细，包含 name(费用名称), amount(金额), paid_by(预交人)。\n"
    "3. cost_sharing (list): 费用分担结果，包含 bearer(承担人), amount(承担金额), type(连带/独立等)。"
)
AMOUNT_LIMIT, LAW_LIMIT, FEE_LIMIT = 12_000, 8_000, 8_000
#: The prompt of the local amount model.
AMOUNT_PROMPT = (
    "你是民事借贷案件金额抽取器。\n"
    "请根据输入中的 Z4_Reasoning 和 Z3_Fact，抽取“最能决定裁判结果的一个金额”。\n"
    "规则：\n"
    "1. 先看 Z4_Reasoning。若能明确识别应支付/偿还金额，则 amount_type=交付金额，source_zone=Z4。\n"
    "2. 若 Z4 不能明确识别，则看 Z3_Fact，提取涉案借款主金额，amount_type=涉案金额，source_zone=Z3。\n"
    "3. target_amount 只保留阿拉伯数字（不带单位，不带逗号）。\n"
    "4. 若无法判断，返回 target_amount 为空字符串，amount_type=unknown，source_zone=none。\n"
    "只输出 JSON 对象，不要输出解释。JSON schema:\n"
    '{"target_amount":"...","amount_type":"交付金额|涉案金额|unknown","source_zone":"Z4|Z3|none"}\n\n'
    "输入：\n"
    "{question_json}\n"
)
#: The prompt of the local citation model.
LAW_PROMPT = (
    "你是中国法律条文结构化抽取专家。请从输入的裁判理由/法律适用文本中，抽取所有被引用的法律条文，"
    '输出JSON对象，格式为 {"citations":[{"law_name":"...","article":"..."}]}。仅输出JSON，不要解释。\n\n'
    "【待抽取文本】\n"
    "{text}\n"
)


def _filled_in(prompt: str, place: str, value: Column) -> Column:
    """A prompt with a value in its only such place."""
    before, after = prompt.split(place)
    return F.concat(F.lit(before), value, F.lit(after))


def local_amount(z4: Column | str, z3: Column | str) -> Column:
    question = json_object(Z4_Reasoning=filled(z4), Z3_Fact=filled(z3))
    return _filled_in(AMOUNT_PROMPT, "{question_json}", question)


def local_law(text: Column | str) -> Column:
    return _filled_in(LAW_PROMPT, "{text}", filled(text))


def chat_amount(z4: Column | str, z3: Column | str) -> Column:
    """The user message of the hosted amount model."""
    return strip(F.concat(F.lit('【Z4】\n"""\n'), filled(z4), F.lit('\n"""\n\n【Z3】\n"""\n'), filled(z3), F.lit('\n"""')))


def chat_law(text: Column | str) -> Column:
    """The user message of the hosted citation model."""
    return strip(F.concat(F.lit('【待抽取文本】\n"""\n'), filled(text), F.lit('\n"""\n\n请输出 JSON。')))


def chat_fee(cost_texts: Column | str, plaintiffs: Column | str, defendants: Column | str) -> Column:
    """The user message of the hosted fee model."""
    return strip(
        F.concat(
            F.lit("【辅助信息】\n原告列表："), list_repr(plaintiffs), F.lit("\n被告列表："), list_repr(defendants), F.lit('\n\n【待分析的费用段落】：\n"""\n'),
            F.array_join(col(cost_texts), "\n"), F.lit('\n"""\n\n请根据上述信息，输出标准的 JSON 数据。'),
        )
    )


def sample(instruction: str, question: Column, answer: Column) -> Column:
    """struct<instruction, question, answer, length> of a training sample, with prefixes."""
    i, q, a = F.lit(INSTRUCTION + instruction), F.concat(F.lit(QUESTION), question), F.concat(F.lit(ANSWER), answer)
    length = lambda s: s.withField("length", F.length(i) + F.length(s["question"]) + F.length(s["answer"]))
    return let(F.struct(i.alias("instruction"), q.alias("question"), a.alias("answer")), length)


def amount_sample(z4: Column, z3: Column, amount: Column, kind: Column, zone: Column) -> Column:
    question = json_object(Z4_Reasoning=flat(filled(z4)), Z3_Fact=flat(filled(z3)))
    return sample(AMOUNT_INSTRUCTION, question, json_object(target_amount=amount, amount_type=kind, source_zone=zone))


def law_sample(text: Column, pairs: Column) -> Column:
    """``pairs`` is array<struct<law_name, article>>."""
    answer = F.concat(F.lit("["), F.array_join(F.transform(pairs, lambda p: json_object(law_name=p["law_name"], article=p["article"])), ", "), F.lit("]"))
    return sample(LAW_INSTRUCTION, flat(text), answer)


def fee_sample(plaintiffs: Column, defendants: Column, cost_texts: Column, result_json: Column) -> Column:
    joined = lambda c: F.replace(F.replace(c, F.lit("\n"), F.lit("")), F.lit("\r"), F.lit(""))
    costs = F.array_join(F.transform(cost_texts, lambda t: strip(joined(t))), "\\n")
    question = F.concat(F.lit("【原告名单】："), joined(list_repr(plaintiffs)), F.lit("\\n【被告名单】："), joined(list_repr(defendants)), F.lit("\\n【费用段落】："), costs)
    return sample(FEE_INSTRUCTION, question, result_json)


def lines(s: Column) -> Column:
    """A sample as three lines; written with an empty line after each."""
    return F.concat_ws("\n", s["instruction"], s["question"], s["answer"], F.lit(""))
