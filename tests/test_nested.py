import json
import random

from conftest import rows

from pagegrain.operators.nested import child_objects, json_objects, page_table


def got(make, *texts):
    df = make([(i, t, "x") for i, t in enumerate(texts)], "response_id int, response_json string, kind string")
    return rows(json_objects(df).select("kind", "record_id", "object_id", "parent_object_id", "text"))


def test_shapes(make):
    box = {"box_2d": [1, 2, 3, 4], "label": 'say "hi" {[\\', "id": 7}
    obj = {"description": "d", "box_2d": "5,6,7,8", "cluster_number": "9", "parts": [{"description": "e", "id": 10, "children": json.dumps([{"description": "f", "id": 11}])}]}
    page = {"boxes_2d": [box], "non_text_objects": [obj]}
    want = lambda i: [("raw_object", i, 10, 9, "e"), ("raw_object", i, 11, 10, "f"), ("raw_object", i, 9, -1, "d"), ("raw_text", i, 7, -1, 'say "hi" {[\\')]
    texts = [json.dumps(page), json.dumps(json.dumps(page)), "```json\n" + json.dumps(page, indent=2) + "\n```", json.dumps([page]), json.dumps({"response": page}), json.dumps({"result": {"page": page, "usage": {"id": 5}}}), json.dumps(page | {"non_text_objects": {"9": {k: v for k, v in obj.items() if k != "cluster_number"}}}), json.dumps(page | {"non_text_objects": obj}), json.dumps(page | {"non_text_objects": json.dumps([obj])})]
    assert got(make, *texts) == sorted((r for i in range(len(texts)) for r in want(i)), key=lambda t: tuple((True, str(x)) for x in t))


def test_broken_null_and_empty_give_nothing(make):
    assert got(make, None, "", "null", "{", '{"boxes_2d": [{"id": 1}', "[]", '{"boxes_2d": null}', "12", '"text"') == []


def test_object_without_number_passes_its_children_up(make):
    t = json.dumps({"non_text_objects": [{"description": "a", "children": [{"description": "b", "id": 3}]}]})
    assert got(make, t) == [("raw_object", 0, 3, -1, "b")]


def test_random_depths_match_recursion(make):
    rnd = random.Random(3)

    def tree(depth, n=[0]):
        n[0] += 1
        me = {"description": "x" * rnd.randrange(4) + '\\"', "id": n[0]}
        if depth and rnd.random() < 0.7:
            me[rnd.choice(["children", "parts", "non_text_objects"])] = [tree(depth - 1) for _ in range(rnd.randrange(3))]
        return me

    pages = [{"non_text_objects": [tree(6) for _ in range(4)]} for _ in range(20)]
    want = []

    def down(i, o, parent):
        want.append(("raw_object", i, o["id"], parent, o["description"]))
        for k in ("children", "parts", "non_text_objects"):
            for c in o.get(k, []):
                down(i, c, o["id"])

    for i, p in enumerate(pages):
        for o in p["non_text_objects"]:
            down(i, o, -1)
    assert got(make, *map(json.dumps, pages)) == sorted(want, key=lambda t: tuple((True, str(x)) for x in t))


def test_long_text_and_boxes(make):
    t = json.dumps({"boxes_2d": [{"box_2d": [1, 2.5, 3, 4], "label": "é" * 3_000_000, "id": 1}]})
    r = json_objects(make([(1, t)], "response_id int, response_json string")).first()
    assert len(r.text) == 3_000_000 and (r.y_min, r.x_min, r.y_max, r.x_max) == (1, 2.5, 3, 4)


PAGE = "page_id long, document_id string, pdf_page_num int, printed_page_number string, contains_table boolean, is_empty_page boolean, incomplete_text boolean, scan_quality string, OCR_text_clusters array<struct<text:string,bb_x_min:double,bb_x_max:double,bb_y_min:double,bb_y_max:double,cluster_number:int>>, non_text_objects array<struct<description:string,bb_x_min:double,bb_x_max:double,bb_y_min:double,bb_y_max:double,cluster_number:int>>, metadata struct<ocr_model_name:string,ocr_datetime:double,ocr_json_version:string>, refined_version struct<OCR_text_clusters:array<struct<text:string,bb_x_min:double,bb_x_max:double,bb_y_min:double,bb_y_max:double,cluster_number:int>>,non_text_objects:array<struct<description:string,bb_x_min:double,bb_x_max:double,bb_y_min:double,bb_y_max:double,cluster_number:int>>>"


def test_refined_members(make):
    t = ("a", 1.0, 2.0, 3.0, 4.0, 5)
    rows_ = [(1, "d", 1, None, None, None, None, None, [t], [], None, ([t], None)), (1, "d", 1, None, None, None, None, None, [t], [], None, ([t], None)), (2, "d", 2, None, None, None, None, None, None, None, None, None), (3, "d", 3, None, None, None, None, None, None, None, None, ([], [("b", 1.0, 1.0, 1.0, 1.0, 6), None]))]
    pages = make(rows_, PAGE)
    none = make([], "response_id long, response_json string")
    assert rows(child_objects(pages, none)) == [("refined_object", 3, 6, -1), ("refined_text", 1, 5, -1)]
    assert page_table(pages).count() == 3
    assert child_objects(pages.limit(0), none).count() == 0


def test_boxes_and_numbers_however_far_apart(make):
    blank = " " * 200
    far = '{"boxes_2d": [{"box_2d": [1,' + blank + "2," + "\n" * 300 + '3.5, 4e1], "label": "a", "id": ' + blank + "9007199254740993" + blank + '}, {"box_2d": "' + "5 , " + blank + '6,7,8", "label": "b", "id": "' + blank + '12"}]}'
    deep = json.dumps({"boxes_2d": [{"box_2d": [10, 20, 30, 40], "label": "c", "id": 7}]}, indent=60)
    beyond = '{"boxes_2d": [{"label": "d", "id": 99999999999999999999}, {"label": "e", "id": [4]}, {"label": "f", "id": 3, "box_2d": [1, 2]}]}'
    r = json_objects(make([(1, far), (2, deep), (3, beyond)], "response_id int, response_json string")).collect()
    assert sorted((x.record_id, x.object_id, x.y_min, x.x_max) for x in r if x.record_id < 3) == [(1, 12, 5.0, 8.0), (1, 9007199254740993, 1.0, 40.0), (2, 7, 10.0, 40.0)]
    assert [(x.object_id, x.y_min) for x in r if x.record_id == 3] == [(3, None)]


def test_completeness_is_that_of_a_json_parser():
    from pagegrain.operators.nested import _Index

    rnd = random.Random(11)

    def value(d=0):
        if d > 4 or rnd.random() < 0.4:
            return rnd.choice([1, -2.5, 1e30, True, None, 'a"b', "\\", "é\n", "", {}, []])
        if rnd.random() < 0.5:
            return {rnd.choice(["id", "a", "b{", "c:", "d,"]): value(d + 1) for _ in range(rnd.randrange(4))}
        return [value(d + 1) for _ in range(rnd.randrange(4))]

    texts = ["", " ", "1 2", '{"a" 1}', '{"a":1,}', "[,]", '"\x01"', '"\\x"', '"\\u12g4"', "{]", "tru", "[01]", '{"a":{"b":1}} x']
    for _ in range(1500):
        t = json.dumps(value(), indent=rnd.choice([None, 2]), ensure_ascii=rnd.random() < 0.5)
        for _ in range(rnd.randrange(3)):
            j = rnd.randrange(len(t) + 1)
            t = rnd.choice([t[:j], t[:j] + t[j + 1 :], t[:j] + rnd.choice('{}[]:,"\\ 1a\n\t') + t[j:]])
        texts.append(t)

    def parses(t):
        try:
            json.loads(t)
        except ValueError:
            return False
        return True

    assert _Index(texts).ok.tolist() == [parses(t) for t in texts]
